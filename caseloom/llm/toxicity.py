"""Toxicity of texts: a linear classifier of character n-grams scaled by log-count ratios.

Features are the presence of n-grams of the lower-cased text's bytes.  Each is scaled by
the naive Bayes log-ratio of how often it occurs in toxic and in other texts; those that
tell little are left out.  A logistic regression on the scaled features gives the score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.batches import add_columns, map_batches
from caseloom.llm.grams import drawn, gram_hashes
from caseloom.session import store

BITS = 24
LENGTHS = range(3, 7)
PRIOR = 10.0  # texts' worth of belief that an n-gram tells nothing
LEAST_RATIO = 1.5
LEAST_TEXTS = 4


@dataclass(frozen=True)
class ToxicityModel:
    features: np.ndarray  # buckets in ascending order
    weights: np.ndarray  # with the ratios multiplied in
    bias: float


class _Known:
    """Finds the features of texts among known buckets."""

    def __init__(self, features: np.ndarray):
        self.features = features
        self.bits = np.zeros(1 << BITS, bool)
        self.bits[features] = True

    def of(self, text: str | None) -> np.ndarray:
        found = [h[self.bits[h]] for h in gram_hashes(text, LENGTHS, BITS)] if text else []
        return np.searchsorted(self.features, np.unique(np.concatenate(found))) if found else np.zeros(0, np.int64)


def gram_counts(sample: DataFrame) -> DataFrame:
    """``bucket, toxic, other``: in how many texts of ``text, toxic`` each n-gram occurs."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        per: list[list[np.ndarray]] = [[np.zeros(0, np.int32)], [np.zeros(0, np.int32)]]
        for text, y in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            if text:
                per[y].append(np.unique(np.concatenate(gram_hashes(text, LENGTHS, BITS) or [np.zeros(0, np.int32)])))
        keys, counts = zip(*(np.unique(np.concatenate(p), return_counts=True) for p in per))
        every = np.union1d(*keys).astype(np.int32)
        n = np.zeros((2, len(every)), np.int64)
        for i in range(2):
            n[i, np.searchsorted(every, keys[i])] = counts[i]
        return pa.RecordBatch.from_arrays([pa.array(every), pa.array(n[1]), pa.array(n[0])], ["bucket", "toxic", "other"])

    made = map_batches(sample, count, "bucket int, toxic long, other long", "text")
    return made.groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def logistic(rows: list[np.ndarray], y: np.ndarray, ratios: np.ndarray, penalty: float, rounds: int) -> tuple[np.ndarray, float]:
    """Weights of the scaled features, and bias; accelerated gradient steps from zero."""
    at = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    x = ratios[at]
    n, d = len(rows), len(ratios)
    v = np.ones(d)
    top = 1.0
    for _ in range(12):  # the largest curvature, for the step
        u = np.bincount(of, x * v[at], n)
        v = np.bincount(at, x * u[of], d)
        top = np.linalg.norm(v) or 1.0
        v /= top
    step = 1 / (0.25 * (top / n + 1) + penalty)
    w, b, w0, b0 = np.zeros(d), 0.0, np.zeros(d), 0.0
    for t in range(rounds):
        m = t / (t + 3)
        ws, bs = w + m * (w - w0), b + m * (b - b0)
        gap = 1 / (1 + np.exp(-np.clip(np.bincount(of, x * ws[at], n) + bs, -40, 40))) - y
        w0, b0 = w, b
        w = ws - step * (np.bincount(at, x * gap[of], d) / n + penalty * ws)
        b = bs - step * gap.mean()
    return w, b


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = 12_000, penalty: float = 1e-3, rounds: int = 150, seed: int = 0) -> ToxicityModel:
    """Model from ``labels`` (``doc_id, toxic``; 0 or 1) of ``docs`` (``doc_id, text``).

    The fit is on a sample of about ``fit_rows`` labelled rows, half of each class (all, if it
    has fewer), drawn by a hash of the id; the number bounds what is sent to all tasks and to
    the driver.  Other labels and labels of documents that are not there teach nothing.
    """
    named = labels.where("toxic IN (0, 1)").select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in named.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    rate = {y: min(1.0, fit_rows / 2 / n) for y, n in counts.items()}
    chosen = F.when(F.col("toxic") == 1, rate.get(1, 0.0)).otherwise(rate.get(0, 0.0))
    some = named.where(drawn(F.col("_id"), chosen, seed))
    sample = store(docs.select("doc_id", "text").join(F.broadcast(some), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "toxic"))
    size = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = size.get(1, 0), size.get(0, 0)
    if not n1 or not n0:
        return ToxicityModel(np.zeros(0, np.int32), np.zeros(0), 40.0 if n1 else -40.0)
    share = n1 / (n1 + n0)
    of_toxic = (F.col("toxic") + PRIOR * share) / (n1 + PRIOR)
    of_other = (F.col("other") + PRIOR * (1 - share)) / (n0 + PRIOR)
    ratio = F.log(of_toxic / of_other)
    told = gram_counts(sample).select("bucket", ratio.alias("r"), (F.col("toxic") + F.col("other")).alias("n"))
    table = told.where((F.abs("r") >= LEAST_RATIO) & (F.col("n") >= LEAST_TEXTS)).toPandas().sort_values("bucket")
    features, ratios = table["bucket"].to_numpy(np.int32), table["r"].to_numpy(np.float64)

    def known(batch: pa.RecordBatch) -> pa.RecordBatch:
        find = _Known(features)
        rows = [find.of(t).astype(np.int32) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.string()), batch.column("toxic"), pa.array(rows, pa.list_(pa.int32()))], ["id", "toxic", "at"])

    got = map_batches(sample, known, "id string, toxic int, at array<int>", "text").collect()
    got.sort(key=lambda r: (r["id"] or "", r["toxic"], r["at"]))
    y = np.array([r["toxic"] for r in got], np.float64)
    w, b = logistic([np.array(r["at"], np.int64) for r in got], y, ratios, penalty, rounds)
    # the classes as often as among all labelled rows, not as in the sample
    b += np.log(counts[1] / counts[0]) - np.log(n1 / n0)
    return ToxicityModel(features, w * ratios, float(b))


def score(docs: DataFrame, model: ToxicityModel, threshold: float = 0.3, text_col: str = "text", score_col: str = "score", name: str = "predicted", keep_text: bool = True) -> DataFrame:
    """Adds ``score`` (0 to 1) and ``predicted`` (1 from the threshold on) to every row and column of ``docs``.

    Null and empty texts have no feature; their score is that of the bias.
    """

    def rate(batch: pa.RecordBatch) -> list[pa.Array]:
        find = _Known(model.features)
        sums = np.array([model.weights[find.of(t)].sum() for t in batch.column(text_col).to_pylist()]) + model.bias
        p = 1 / (1 + np.exp(-np.clip(sums, -40, 40)))
        return [pa.array(p), pa.array((p >= threshold).astype(np.int32))]

    return add_columns(docs, rate, f"{score_col} double, {name} int", text_col, keep_text)
