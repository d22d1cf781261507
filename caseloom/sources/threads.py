"""Messages laid out once for all joins of a message with its replies.

Messages are bucketed by their id and replies by the id they answer, in equally many buckets,
so that each of the joins reads both sides bucket by bucket and shuffles neither.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.session import Stores

ROWS_PER_BUCKET = 1_000_000
KEYS = {"messages": "tweet_id", "replies": "in_response_to_tweet_id"}


@dataclass(frozen=True)
class Threads:
    """Tables of one layout.  A message id is in the bucketed tables or in the hot ones, never in both."""

    messages: DataFrame
    replies: DataFrame
    hot_messages: DataFrame
    hot_replies: DataFrame

    def each(self, join: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
        """``join(messages, replies)``, an operator that matches replies to the ids they answer.

        The hot ids have tables of their own without buckets, whose join is planned by their
        size and whose large partitions adaptive execution splits.
        """
        return join(self.messages, self.replies).unionByName(join(self.hot_messages, self.hot_replies))


def save_threads(tweets: DataFrame, path: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> str:
    """Write the layout of ``tweets`` (overwriting the path): as many buckets as give ``rows_per_bucket`` rows on average.

    An id that more rows than that have, or answer, is hot.  A message without an id is in no
    table as a message, and one that answers nothing is no reply.  All columns are kept.
    """
    spark = tweets.sparkSession
    kept = Stores()
    sides = {name: tweets.where(F.col(key).isNotNull()) for name, key in KEYS.items()}
    counts = [df.groupBy(F.col(KEYS[name]).alias("_id")).agg(F.count(F.lit(1)).alias("_n")) for name, df in sides.items()]
    sizes = [kept.keep(c) for c in counts]
    most = max(c.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).first()["n"] for c in sizes)
    buckets = max(1, -(-most // rows_per_bucket))
    hot = kept.keep(sizes[0].unionByName(sizes[1]).where(F.col("_n") > rows_per_bucket).select("_id").distinct())
    for name, df in sides.items():
        key = KEYS[name]
        rest = df.join(hot, F.col(key) == F.col("_id"), "left_anti").repartition(buckets, key)
        table = f"threads_{uuid4().hex}"
        rest.write.bucketBy(buckets, key).sortBy(key).option("path", f"{path}/{name}").mode("overwrite").format("parquet").saveAsTable(table)
        spark.sql(f"DROP TABLE {table}")  # the files stay; whoever opens them names them anew
        df.join(hot, F.col(key) == F.col("_id"), "left_semi").write.mode("overwrite").parquet(f"{path}/hot_{name}")
    spark.createDataFrame([(buckets,)], "buckets int").write.mode("overwrite").parquet(f"{path}/layout")
    kept.remove()
    return path


def open_threads(spark: SparkSession, path: str) -> Threads:
    """The layout at a path; its bucketed tables get names in the session's catalog."""
    buckets = spark.read.parquet(f"{path}/layout").first()["buckets"]
    tables = {}
    for name, key in KEYS.items():
        hot = tables[f"hot_{name}"] = spark.read.parquet(f"{path}/hot_{name}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in hot.schema)
        table = f"threads_{uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}/{name}'"
        )
        tables[name] = spark.table(table)
    return Threads(**tables)
