"""Language of texts by a string kernel with Nyström landmarks and kernel ridge regression.

Two texts are as alike as the share of n-grams of one to ``grams`` bytes that both have
(blended spectrum, presence only, normalised to 1 for equal texts).  A text is described by
its likeness to landmark texts, made orthonormal (Nyström), and a one-versus-rest ridge
regression for each language scores that description.  Texts are scored in batches: two
matrix products for each.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.batches import add_columns
from caseloom.llm.grams import drawn, gram_hashes

BITS = 13
UNDETERMINED = "und"


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


@dataclass(frozen=True)
class LanguageModel:
    names: list[str]
    grams: int
    landmarks: np.ndarray  # packed presence bits, one row per landmark
    weights: np.ndarray  # landmarks x languages, with the Nyström map folded in
    bias: np.ndarray


def presence(texts: list[str], grams: int) -> np.ndarray:
    """Texts x buckets, 1 where the text has an n-gram of that bucket."""
    out = np.zeros((len(texts), 1 << BITS), np.float32)
    for row, text in zip(out, texts):
        for h in gram_hashes(text, range(1, grams + 1), BITS):
            row[h] = 1
    return out


def kernel(x: np.ndarray, z: np.ndarray) -> np.ndarray:
    norm = np.sqrt(np.maximum(1, x.sum(1)))[:, None] * np.sqrt(np.maximum(1, z.sum(1)))[None, :]
    return (x @ z.T) / norm


def solve(texts: list[str], langs: list[str], grams: int, landmarks: int, ridge: float) -> LanguageModel:
    """Fits on these texts; the first of each language, equally many, are the landmarks."""
    names = sorted(set(langs))
    if not names:
        return LanguageModel([], grams, np.zeros((0, (1 << BITS) // 8), np.uint8), np.zeros((0, 0)), np.zeros(0))
    each = max(1, landmarks // len(names))
    chosen = [i for n in names for i in [j for j, x in enumerate(langs) if x == n][:each]]
    x = presence(texts, grams)
    z = x[chosen]
    values, vectors = np.linalg.eigh(kernel(z, z).astype(np.float64))
    keep = values > 1e-6 * values.max()
    to_phi = vectors[:, keep] / np.sqrt(values[keep])
    phi = kernel(x, z).astype(np.float64) @ to_phi
    y = np.array([[float(x == n) for n in names] for x in langs])
    share = np.array([1 / (len(names) * max(1, langs.count(x))) for x in langs])[:, None]  # languages count alike
    mean, base = (share * phi).sum(0), (share * y).sum(0)
    centred = phi - mean
    w = np.linalg.solve(centred.T @ (share * centred) + ridge * np.eye(phi.shape[1]), centred.T @ (share * (y - base)))
    return LanguageModel(names, grams, np.packbits(z.astype(bool), axis=1), to_phi @ w, base - mean @ w)


def fit(docs: DataFrame, fit_rows: int = 1500, landmarks: int = 96, grams: int = 3, ridge: float = 1e-4, seed: int = 0) -> LanguageModel:
    """Model of the values of ``lang``, learnt from ``doc_id, text, lang``.

    Rows without a language or a letter teach nothing.  The fit is on a sample: about
    ``fit_rows`` rows of each language (all, if it has fewer), drawn by a hash of the id.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return solve([], [], grams, landmarks, ridge)
    rates = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, fit_rows / n))])
    sample = usable.where(drawn(F.col("doc_id"), rates[F.col("lang")], seed))
    rows = sorted((r["lang"], str(r["doc_id"]), r["text"]) for r in sample.collect() if has_letter(r["text"]))
    return solve([r[2] for r in rows], [r[0] for r in rows], grams, landmarks, ridge)


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text", name: str = "lang_pred", score: str = "score", keep_text: bool = True) -> DataFrame:
    """Adds ``lang_pred`` and ``score`` (0 to 1) to every row and column of ``docs``.

    The language is ``und`` with score 0 for texts that are null or have no letter, and for
    all texts if the model has learnt nothing.  Ties go to the first name.
    """

    def label(batch: pa.RecordBatch) -> list[pa.Array]:
        texts = batch.column(text_col).to_pylist()
        names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        z = np.unpackbits(model.landmarks, axis=1, count=1 << BITS).astype(np.float32)
        told = [i for i, t in enumerate(texts) if model.names and has_letter(t)]
        for lo in range(0, len(told), 128):
            part = told[lo : lo + 128]
            f = kernel(presence([texts[i] for i in part], model.grams), z) @ model.weights + model.bias
            best = f.argmax(1)
            for i, b, s in zip(part, best.tolist(), f.max(1).tolist()):
                names[i], scores[i] = model.names[b], min(1.0, max(0.0, s))
        return [pa.array(names, pa.string()), pa.array(scores)]

    return add_columns(docs, label, f"{name} string, {score} double", text_col, keep_text)
