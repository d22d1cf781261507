"""The message operators on streams: triage, pairing with latency, and counts per time window."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from caseloom import config
from caseloom.functions import text as X
from caseloom.operators import similarity
from caseloom.plans.triage import Classifier, triage
from caseloom.session import Stores


def read_stream(spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet") -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)


def triage_stream(
    messages: DataFrame,
    classifier: Classifier,
    index: similarity.CaseIndex | None,
    out: str,
    checkpoint: str,
    cfg: config.TriageConfig = config.DEFAULT,
    available_now: bool = True,
    **options,
) -> StreamingQuery:
    """Triage every micro-batch against a loaded index.

    A batch goes to a folder named after it and overwrites it, so a batch that is
    repeated after a failure is not written twice.  Its intermediate tables are removed with it.
    """

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        stores = Stores()
        try:
            result = triage(batch, classifier, index, cfg=cfg, keep=stores.keep, **options)
            result.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        finally:
            stores.remove()

    writer = messages.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def pair_stream(customers: DataFrame, brands: DataFrame, max_wait: str = "7 days", lateness: str = "1 day") -> DataFrame:
    """Join replies to the messages they answer within a time bound, with the latency in minutes.

    Both sides need a timestamp ``created_at``; the bound lets Spark drop state.
    """
    c = customers.select(
        F.col("tweet_id").alias("customer_tweet_id"),
        F.col("author_id").alias("customer_user"),
        F.col("text").alias("customer_message"),
        F.col("created_at").alias("customer_timestamp"),
    ).withWatermark("customer_timestamp", lateness)
    b = brands.select(
        F.col("in_response_to_tweet_id").alias("answers"),
        F.col("tweet_id").alias("brand_tweet_id"),
        F.col("author_id").alias("brand_account"),
        F.col("text").alias("brand_reply"),
        F.col("created_at").alias("brand_timestamp"),
    ).withWatermark("brand_timestamp", lateness)
    within = (
        (F.col("answers") == F.col("customer_tweet_id"))
        & (F.col("brand_timestamp") >= F.col("customer_timestamp"))
        & (F.col("brand_timestamp") <= F.col("customer_timestamp") + F.expr(f"INTERVAL {max_wait}"))
    )
    return c.join(b, within).drop("answers").withColumn(
        "reply_time_minutes", X.minutes_between("brand_timestamp", "customer_timestamp")
    )


def windowed_counts(df: DataFrame, time: str, label: str, window: str = "1 hour", lateness: str = "1 hour") -> DataFrame:
    """Rows per label and tumbling window."""
    counts = df.withWatermark(time, lateness).groupBy(F.window(time, window).alias("w"), label)
    return counts.agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), label, "n")
