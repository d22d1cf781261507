"""Best partners of sparse vectors from products of blocks, where rows of pairs would fill the disk.

Queries and vectors are dealt out by a hash into blocks of a bounded number of entries, and
every block of queries meets every block of vectors in a task.  Only a block's best pairs
leave it, so what is shuffled are the vectors, once for each block on the other side.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPS = 1e-8
ENTRIES = 1_000_000  # of a block, about; some 30 MB in a worker
LEAST = 1_000  # entries for which a block of its own pays
CHUNK = 64


def best_of_blocks(q_terms: DataFrame, postings: DataFrame, top_k: int, entries: int = ENTRIES) -> DataFrame:
    """The ``top_k`` best vectors of every query in every block of vectors: ``q_key, vec_id, score, rank_score``.

    ``q_terms`` is ``(q_key, term, q_weight)``, ``postings`` ``(vec_id, term, weight)``, with a term once per
    query or vector.  All scores above 0 are made; both tables are read twice, once to count them.
    """
    spread = math.ceil(math.sqrt(4 * q_terms.sparkSession.sparkContext.defaultParallelism))

    def blocks(df: DataFrame) -> int:
        n = df.count()
        return max(1, min(spread, n // LEAST), math.ceil(n / entries))

    n_asked, n_held = blocks(q_terms), blocks(postings)
    held = postings.select(
        "vec_id", "term", "weight", F.pmod(F.xxhash64("vec_id"), F.lit(n_held)).cast("int").alias("_held"),
        F.explode(F.sequence(F.lit(0), F.lit(n_asked - 1))).alias("_asked"),
    )
    asked = q_terms.select(
        "q_key", "term", "q_weight", F.pmod(F.xxhash64("q_key"), F.lit(n_asked)).cast("int").alias("_asked"),
        F.explode(F.sequence(F.lit(0), F.lit(n_held - 1))).alias("_held"),
    )
    schema = T.StructType([
        T.StructField("q_key", q_terms.schema["q_key"].dataType),
        T.StructField("vec_id", postings.schema["vec_id"].dataType),
        T.StructField("score", T.DoubleType()),
        T.StructField("rank_score", T.DoubleType()),
    ])
    met = held.groupBy("_asked", "_held").cogroup(asked.groupBy("_asked", "_held"))
    return met.applyInArrow(lambda h, a: best_pairs(h, a, top_k), schema)


def _by(codes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of entries by their code, and where each of ``n`` codes begins in it."""
    order = np.argsort(codes, kind="stable")
    return order, np.searchsorted(codes[order], np.arange(n + 1))


def best_pairs(held: pa.Table, asked: pa.Table, top_k: int) -> pa.Table:
    """One block against another: scores are added up term by term into an array of one query's scores."""
    terms, queries, vecs = (pc.unique(c) for c in (held["term"], asked["q_key"], held["vec_id"]))
    vecs = vecs.take(pc.sort_indices(vecs))  # so that places are in the order of ids, which decides ties

    def codes(column, values):
        return pc.fill_null(pc.index_in(column, values), -1).to_numpy()

    order, begins = _by(codes(held["term"], terms), len(terms))
    places, weights = codes(held["vec_id"], vecs)[order], held["weight"].to_numpy()[order]
    q_order, q_begins = _by(codes(asked["q_key"], queries), len(queries))
    q_codes, q_weights = codes(asked["term"], terms)[q_order], asked["q_weight"].to_numpy()[q_order]
    scores = np.zeros(-(-len(vecs) // CHUNK) * CHUNK)
    n_chunks = len(scores) // CHUNK
    out: list[tuple] = []
    for q in range(len(queries)):
        mine = slice(q_begins[q], q_begins[q + 1])
        scores[:] = 0.0
        for code, weight in zip(q_codes[mine], q_weights[mine]):
            if code >= 0:
                at = slice(begins[code], begins[code + 1])
                scores[places[at]] += weight * weights[at]
        # as many chunks as are wanted have a score of at least the bar
        tops = scores.reshape(-1, CHUNK).max(axis=1)
        bar = np.partition(tops, n_chunks - top_k)[n_chunks - top_k] - EPS if n_chunks > top_k else 0.0
        found = np.flatnonzero(scores >= bar if bar > 0 else scores > 0)
        ranks = np.round(scores[found], 9)
        first = np.argsort(-ranks, kind="stable")[:top_k]
        out.append((np.full(len(first), q), found[first], scores[found[first]], ranks[first]))
    q, v, s, r = (np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, int), np.zeros(0, int), np.zeros(0), np.zeros(0))
    return pa.table({"q_key": queries.take(pa.array(q)), "vec_id": vecs.take(pa.array(v)), "score": s, "rank_score": r})
