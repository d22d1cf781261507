"""Baselines on the golden set: metrics, matrix, errors, confidence bins and comparison."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.operators import classify, metrics
from caseloom.session import store

MAJORITY = "Majority Baseline"
TFIDF = "TF-IDF + Logistic Regression"


def majority_report(train: DataFrame, golden: DataFrame) -> DataFrame:
    test = golden.select("example_id", F.col("intent").alias("true_intent"))
    return metrics.classification_report(metrics.predict_majority(test, train), MAJORITY)


def tfidf_results(model: PipelineModel, golden: DataFrame) -> dict[str, DataFrame]:
    """All result tables of one fitted model; the predictions are computed once."""
    predictions = metrics.require_same_count(store(classify.predict_golden(golden, model)), golden)
    return {
        "predictions": predictions,
        "report": metrics.classification_report(predictions, TFIDF),
        "confusion_matrix": metrics.confusion_matrix(predictions),
        "errors": metrics.error_table(predictions, golden),
        "top_confusions": metrics.top_confusions(predictions),
        "confidence_bins": metrics.confidence_bins(predictions),
    }


def compare_baselines(train: DataFrame, golden: DataFrame, model: PipelineModel) -> DataFrame:
    return metrics.compare_models([majority_report(train, golden), tfidf_results(model, golden)["report"]])
