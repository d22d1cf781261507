from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from caseloom.operators import classify as C


def test_iterations_run_on_even_partitions(spark, monkeypatch):
    """Training rows in 37 partitions, most of them empty, are fitted in as many even ones as the cores take."""
    seen, fit = [], LogisticRegression.fit

    def watched(self, data):
        seen.extend(r["count"] for r in data.groupBy(F.spark_partition_id()).count().collect())
        return fit(self, data)

    monkeypatch.setattr(LogisticRegression, "fit", watched)
    word = F.when(F.col("id") % 2 == 0, F.lit("refund ")).otherwise(F.lit("login "))
    rows = spark.range(160).select(F.concat(word, F.lit("w"), F.col("id") % 5).alias("customer_message"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("intent"))
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    model = C.fit_classifier(rows.repartition(37, "intent"), stop_words=())
    parts = 2 * spark.sparkContext.defaultParallelism
    assert sum(seen) == 160 and len(seen) == parts and max(seen) <= 2 * 160 / parts
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == before
    told = C.classify(rows.withColumnRenamed("customer_message", "message"), model)
    assert told.where("classification.intent <> intent").isEmpty()
