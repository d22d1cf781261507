"""Published figures: the 7x7 matrix in, the published metrics out."""

import pytest
from pyspark.sql import functions as F

from caseloom.operators import metrics as M

LABELS = ["account_access", "app_bug", "billing_issue", "feature_inquiry", "other", "playback_issue", "subscription_issue"]
MATRIX = [
    [24, 1, 0, 0, 4, 1, 0],
    [0, 23, 0, 0, 7, 0, 0],
    [0, 0, 28, 0, 2, 0, 0],
    [0, 0, 0, 14, 16, 0, 0],
    [0, 0, 0, 0, 30, 0, 0],
    [0, 0, 0, 0, 0, 30, 0],
    [0, 0, 0, 0, 1, 1, 28],
]


@pytest.fixture(scope="module")
def predictions(spark):
    cells = [(t, p, MATRIX[i][j]) for i, t in enumerate(LABELS) for j, p in enumerate(LABELS)]
    df = spark.createDataFrame(cells, "true_intent string, predicted_intent string, n int")
    return df.where("n > 0").select("true_intent", "predicted_intent", F.explode(F.sequence(F.lit(1), "n")).alias("i"))


def values(report):
    return {(r["metric"], r["label"]): r["value"] for r in report.collect()}


def test_published_metrics(predictions):
    v = values(M.classification_report(predictions, "m"))
    assert v["accuracy", ""] == pytest.approx(0.8428571428571429)
    assert v["macro_precision", ""] == pytest.approx(0.9136904761904763)
    assert v["macro_recall", ""] == pytest.approx(0.8428571428571429)
    assert v["macro_f1", ""] == pytest.approx(0.8489353517162194)
    assert v["weighted_f1", ""] == pytest.approx(0.8489353517162193)
    assert v["per_intent_f1", "feature_inquiry"] == pytest.approx(0.6363636363636364)
    assert v["per_intent_precision", "playback_issue"] == pytest.approx(0.9375)
    assert v["per_intent_recall", "app_bug"] == pytest.approx(0.7666666666666667)


def test_majority_baseline(spark, predictions):
    train = spark.createDataFrame([("other",), ("other",), ("app_bug",)], "intent string")
    assert M.majority_label(train).first()[0] == "other"
    v = values(M.classification_report(M.predict_majority(predictions.select("true_intent"), train), "m"))
    assert v["accuracy", ""] == pytest.approx(0.14285714285714285)
    assert v["macro_precision", ""] == pytest.approx(0.02040816326530612)
    assert v["macro_f1", ""] == pytest.approx(0.03571428571428571)
    assert v["per_intent_f1", "app_bug"] == 0


def test_majority_tie_takes_the_smallest(rows):
    assert M.majority_label(rows([("b",), ("a",)], "intent string")).first()[0] == "a"


def test_predicted_only_label_counts_in_macro(rows):
    df = rows([("a", "a"), ("a", "z")], "true_intent string, predicted_intent string")
    v = values(M.classification_report(df, "m"))
    assert v["macro_recall", ""] == pytest.approx(0.25)
    assert ("per_intent_f1", "z") not in v


def test_confusion_matrix(predictions):
    m = M.confusion_matrix(predictions, list(LABELS))
    got = [list(r)[1:] for r in m.orderBy("true_intent").collect()]
    assert m.columns == ["true_intent", *LABELS] and got == MATRIX
    long = {(r["true_intent"], r["predicted_intent"]): r["n"] for r in M.confusion_matrix(predictions).collect()}
    assert long == {(a, b): MATRIX[i][j] for i, a in enumerate(sorted(LABELS)) for j, b in enumerate(sorted(LABELS))}


def test_confusion_matrix_of_many_labels(spark):
    df = spark.range(1200).selectExpr("concat('l', id) AS true_intent", "concat('l', id - id % 2) AS predicted_intent")
    long = M.confusion_matrix(df)
    assert long.count() == 1200 * 1200 and long.agg(F.sum("n")).first()[0] == 1200


def test_top_confusions(predictions):
    df = predictions.withColumn("correct", F.col("true_intent") == F.col("predicted_intent"))
    first = M.top_confusions(df).collect()[:2]
    assert [tuple(r) for r in first] == [("feature_inquiry", "other", 16), ("app_bug", "other", 7)]


def test_confidence_bins_are_closed_on_the_right(rows):
    df = rows([(0.0, True), (0.2, True), (0.2001, False), (1.0, True)], "confidence double, correct boolean")
    got = {r["conf_bin"]: (r["incorrect_predictions"], r["correct_predictions"]) for r in M.confidence_bins(df).collect()}
    assert got == {"0.0–0.2": (0, 2), "0.2–0.4": (1, 0), "0.4–0.6": (0, 0), "0.6–0.8": (0, 0), "0.8–1.0": (0, 1)}


def test_errors_are_sorted_with_source(rows):
    p = rows([("e1", False, 0.5), ("e2", False, 0.9), ("e3", True, 1.0)], "example_id string, correct boolean, confidence double")
    g = rows([("e1", "c1"), ("e2", "c2")], "example_id string, source_case_id string")
    assert [(r["example_id"], r["source_case_id"]) for r in M.error_table(p, g).collect()] == [("e2", "c2"), ("e1", "c1")]


def test_compare_and_count_check(predictions):
    table = M.compare_models([M.classification_report(predictions, "x"), M.classification_report(predictions, "y")])
    assert table.columns == ["model", *M.SCALARS] and table.count() == 2
    with pytest.raises(ValueError):
        M.require_same_count(predictions, predictions.limit(3))
