"""Baselines and classification reports, all from the counts of (true, predicted) pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom import config

SCALARS = ("accuracy", "macro_precision", "macro_recall", "macro_f1", "weighted_f1")


def majority_label(train: DataFrame, column: str = "intent") -> DataFrame:
    """Most frequent label; the smallest one on a tie."""
    counts = train.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), column).limit(1).select(F.col(column).alias("majority_class"))


def predict_majority(test: DataFrame, train: DataFrame) -> DataFrame:
    """Test rows with the majority label of the training rows as prediction."""
    return test.withColumn("predicted_intent", majority_label(train).scalar())


def prediction_table(scored: DataFrame) -> DataFrame:
    return scored.select(
        "example_id",
        "customer_message",
        "true_intent",
        "predicted_intent",
        (F.col("true_intent") == F.col("predicted_intent")).alias("correct"),
        "confidence",
    )


def require_same_count(predictions: DataFrame, test: DataFrame) -> DataFrame:
    """Check that every test row has one prediction."""
    got, want = predictions.count(), test.count()
    if got != want:
        raise ValueError(f"{got} predictions for {want} test rows")
    return predictions


def pair_counts(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("true_intent", "predicted_intent").agg(F.count(F.lit(1)).alias("n"))


def label_metrics(counts: DataFrame) -> DataFrame:
    """Support, precision, recall and F1 of every true or predicted label; 0 where undefined."""
    hit = F.col("true_intent") == F.col("predicted_intent")
    sides = F.array(
        F.struct(F.col("true_intent").alias("intent"), F.col("n").alias("s"), F.lit(0).cast("long").alias("p")),
        F.struct(F.col("predicted_intent").alias("intent"), F.lit(0).cast("long").alias("s"), F.col("n").alias("p")),
    )
    per_label = (
        counts.select(F.inline(sides), F.when(hit, F.col("n")).otherwise(0).alias("h"))
        .groupBy("intent")
        .agg(F.sum("s").alias("support"), F.sum("p").alias("predicted"), F.sum(F.when(F.col("s") > 0, F.col("h"))).alias("tp"))
    )
    tp = F.coalesce("tp", F.lit(0))
    zero = F.lit(0.0)
    return per_label.select(
        "intent",
        "support",
        "predicted",
        tp.alias("tp"),
        F.coalesce(F.try_divide(tp, "predicted"), zero).alias("precision"),
        F.coalesce(F.try_divide(tp, "support"), zero).alias("recall"),
        F.coalesce(F.try_divide(2 * tp, F.col("support") + F.col("predicted")), zero).alias("f1"),
    )


def overall_metrics(per_label: DataFrame) -> DataFrame:
    total = F.sum("support")
    return per_label.agg(
        F.coalesce(F.try_divide(F.sum("tp"), total), F.lit(0.0)).alias("accuracy"),
        F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"),
        F.avg("f1").alias("macro_f1"),
        F.coalesce(F.try_divide(F.sum(F.col("f1") * F.col("support")), total), F.lit(0.0)).alias("weighted_f1"),
    )


def classification_report(predictions: DataFrame, model: str) -> DataFrame:
    """Long report ``(model, metric, label, value)``; per-label rows cover the true labels only."""
    per_label = label_metrics(pair_counts(predictions))
    overall = overall_metrics(per_label).unpivot([], list(SCALARS), "metric", "value").withColumn("label", F.lit(""))
    by_label = (
        per_label.where("support > 0")
        .withColumnRenamed("intent", "label")
        .unpivot(["label"], ["f1", "precision", "recall"], "metric", "value")
        .withColumn("metric", F.concat(F.lit("per_intent_"), "metric"))
    )
    both = overall.select("metric", "label", "value").unionByName(by_label.select("metric", "label", "value"))
    return both.select(F.lit(model).alias("model"), "metric", "label", "value")


def compare_models(reports: list[DataFrame]) -> DataFrame:
    """One row per model with the five overall metrics."""
    union = reports[0]
    for r in reports[1:]:
        union = union.unionByName(r)
    return union.where("label = ''").groupBy("model").pivot("metric", list(SCALARS)).agg(F.first("value"))


def confusion_matrix(predictions: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """True labels by predicted labels, zero-filled.

    Without ``labels`` in long form, ``true_intent, predicted_intent, n`` for every pair of
    labels that occur as true ones; with them as one row per label and one column per label.
    """
    counts = pair_counts(predictions)
    if labels is None:
        every = counts.where(F.col("true_intent").isNotNull()).select("true_intent").distinct()
        axis = every.agg(F.array_sort(F.collect_list("true_intent"))).scalar()
        cells = every.withColumn("predicted_intent", F.explode(axis))
        found = cells.join(counts, ["true_intent", "predicted_intent"], "left")
        return found.select("true_intent", "predicted_intent", F.coalesce("n", F.lit(0)).alias("n"))
    cells = [
        F.coalesce(F.sum(F.when(F.col("predicted_intent") == label, F.col("n"))), F.lit(0)).alias(label) for label in labels
    ]
    every = predictions.sparkSession.createDataFrame([(x,) for x in labels], "true_intent string")
    wide = every.join(counts.where(F.col("true_intent").isin(labels)).groupBy("true_intent").agg(*cells), "true_intent", "left")
    return wide.na.fill(0, subset=labels)


def confidence_bins(predictions: DataFrame) -> DataFrame:
    """Correct and incorrect predictions per confidence bin; edges belong to the lower bin."""
    binned = F.lit(None).cast("int")
    for number, _, upper in reversed(config.CONFIDENCE_BINS):
        binned = F.when(F.col("confidence") <= upper, F.lit(number)).otherwise(binned)
    counts = predictions.where(F.col("confidence") >= 0).groupBy(binned.alias("bin")).agg(
        F.count_if(~F.col("correct")).alias("incorrect_predictions"), F.count_if("correct").alias("correct_predictions")
    )
    bins = predictions.sparkSession.createDataFrame(
        [(n, name) for n, name, _ in config.CONFIDENCE_BINS], "bin int, conf_bin string"
    )
    return bins.join(counts, "bin", "left").drop("bin").na.fill(0)


def error_table(predictions: DataFrame, golden: DataFrame) -> DataFrame:
    """Wrong predictions with the source case, surest first."""
    sources = golden.select("example_id", "source_case_id")
    wrong = predictions.where(~F.col("correct")).join(sources, "example_id", "left")
    return wrong.orderBy(F.desc("confidence"), "example_id")


def confusion_pairs(predictions: DataFrame) -> DataFrame:
    """Errors per (true, predicted) pair."""
    return pair_counts(predictions.where(~F.col("correct")))


def top_confusions(predictions: DataFrame, n: int = 5) -> DataFrame:
    return confusion_pairs(predictions).orderBy(F.desc("n"), "true_intent", "predicted_intent").limit(n)
