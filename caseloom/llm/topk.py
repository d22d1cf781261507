"""Exact top-k by inner product with sequential reads of sorted lists only (no random access).

For each dimension a block of vectors has a list of its components in order.  A query reads
every list from the end that helps it most.  What it has read of a vector bounds the score:
from below with the worst value of each list not read yet, from above with the value where
reading stands.  Reading stops when no vector outside of the best k can still qualify; the
final scores of those left are resolved then.  Blocks are read one after another and the
k-th best lower bound goes on from block to block.

Queries and vectors are dealt to blocks of bounded size; each task takes one block of queries
and a share of the vectors, and the best of all shares are ranked at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseloom.llm.batches import cores
from caseloom.session import store

QUERY_BLOCK = 4096
LIST_BLOCK = 2048
QUERY_STEP = 256
LIMIT = float(1 << 63)  # what a 64-bit component holds
UNDER = -(1 << 63)
LARGE = 1 << 26  # vectors with such components are scored apart


def whole_components(vectors: DataFrame, id_col: str, vector_col: str, scale: float = 64.0) -> DataFrame:
    """``vec_id, dim, x``: components as floor(scale * value), for vectors that take part.

    Vectors that are null or hold a null or non-finite component, or one of 2^63 or more after
    scaling, which no 64-bit number holds, and rows without an id, take no part.
    """
    value = F.transform(F.col(vector_col), lambda x: F.floor(x.cast("double") * F.lit(scale)))
    fine = F.forall(F.col(vector_col), lambda x: x.isNotNull() & (F.abs(x.cast("double") * F.lit(scale)) < F.lit(LIMIT)))
    ok = F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & F.coalesce(fine, F.lit(False))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col)).where(ok)
    return rows.select("vec_id", F.size(vector_col).alias("dim"), value.cast("array<long>").alias("x"))


class _Best:
    """The k best of each query so far, by score and then smaller id."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, k: int):
        self.ids, self.q, self.k = ids, q, k
        self.score = np.zeros((len(ids), 0), np.int64)
        self.vec = np.zeros((len(ids), 0), np.int64)
        self.real = np.zeros((len(ids), 0), bool)

    def floor(self, rows: slice) -> np.ndarray:
        """The k-th best score of each query; below all scores while there are fewer than k."""
        if self.score.shape[1] < self.k:
            return np.full(rows.stop - rows.start, -np.inf)
        return np.where(self.real[rows, -1], self.score[rows, -1].astype(np.float64), -np.inf)

    def add(self, query: np.ndarray, vec: np.ndarray, score: np.ndarray) -> None:
        """Takes scored pairs in and keeps the k best of each query."""
        n, k = self.score.shape
        order = np.argsort(query, kind="stable")
        query, vec, score = query[order], vec[order], score[order]
        nth = np.arange(len(query)) - np.searchsorted(query, query)
        wide = k + (int(nth.max()) + 1 if len(nth) else 0)
        s, v, r = np.zeros((n, wide), np.int64), np.zeros((n, wide), np.int64), np.zeros((n, wide), bool)
        s[:, :k], v[:, :k], r[:, :k] = self.score, self.vec, self.real
        s[query, k + nth], v[query, k + nth], r[query, k + nth] = score, vec, True
        rank = np.lexsort((v, -s, ~r), axis=1)[:, : self.k]
        self.score, self.vec, self.real = (np.take_along_axis(a, rank, 1) for a in (s, v, r))


def _whole(best: _Best, rows: slice, ids: np.ndarray, x: np.ndarray, kind: type) -> None:
    """Scores all pairs in whole numbers of any size.  Scores over 64 bits are an error; those under are
    ``UNDER`` here, and an error only if they are among the best of all."""
    score = best.q[rows].astype(kind) @ x.astype(kind).T
    for i, own in enumerate(score):
        others = np.flatnonzero(ids != best.ids[rows.start + i])
        found = sorted(others.tolist(), key=lambda j: (-own[j], ids[j]))[: best.k]
        if found:
            best.add(np.full(len(found), rows.start + i), ids[found], np.array([max(UNDER, int(own[j])) for j in found], np.int64))


def _search(best: _Best, ids: np.ndarray, x: np.ndarray) -> None:
    """Reads the sorted lists of one block of vectors for all queries of a block."""
    n, dim = x.shape
    most = float(np.abs(x).max(initial=0)) * max(1, dim)
    steps = [slice(lo, min(lo + QUERY_STEP, len(best.ids))) for lo in range(0, len(best.ids), QUERY_STEP)]
    largest = [most * float(np.abs(best.q[rows]).max(initial=0)) for rows in steps]
    for rows, top in zip(steps, largest):
        if top >= 2**53:  # sums of doubles would not be exact
            _whole(best, rows, ids, x, np.int64 if top < 2**62 else object)
    steps = [rows for rows, top in zip(steps, largest) if top < 2**53]
    if not steps:
        return
    number = np.float32 if max(top for top in largest if top < 2**53) < 2**24 else np.float64
    by = np.argsort(x, axis=0, kind="stable")
    rank = np.empty_like(by)
    np.put_along_axis(rank, by, np.arange(n)[:, None], axis=0)
    lists = np.take_along_axis(x, by, axis=0).astype(number)  # ascending
    plain = x.astype(number)
    depths = [d for d in (n // 4, n // 2) if d >= best.k]
    seen = {}
    for d in depths:  # what is known of each vector, for lists read from their large or their small end
        top, low = rank >= n - d, rank < d
        worst = np.hstack([np.where(top, plain, lists[0]), np.where(low, plain, lists[-1])]).T
        hoped = np.hstack([np.where(top, plain, lists[n - d]), np.where(low, plain, lists[d - 1])]).T
        seen[d] = np.ascontiguousarray(worst), np.ascontiguousarray(hoped)
    for rows in steps:
        lo = rows.start
        q = best.q[rows].astype(number)
        signed = np.hstack([np.maximum(q, 0), np.minimum(q, 0)])
        floor = best.floor(rows)
        alive = ids[None, :] != best.ids[rows][:, None]
        reading, done = np.arange(len(q)), []
        for d in depths:
            lower, upper = (signed[reading] @ m for m in seen[d])
            lower[~alive[reading]] = -np.inf
            floor[reading] = np.maximum(floor[reading], np.partition(lower, n - best.k, axis=1)[:, n - best.k])
            alive[reading] &= upper >= floor[reading][:, None]
            few = alive[reading].sum(1) <= 4 * best.k  # no outsider can qualify: resolve these
            done.append(reading[few])
            reading = reading[~few]
            if not len(reading):
                break
        out = []
        if sum(map(len, done)):
            at = np.concatenate(done)
            row, vec = np.nonzero(alive[at])
            row = at[row]
            out.append((row, vec, np.einsum("ij,ij->i", q[row], plain[vec])))
        if len(reading):  # read to the end, where both bounds are the score
            score = q[reading] @ plain.T
            score[~alive[reading]] = -np.inf
            if n >= best.k:
                floor[reading] = np.maximum(floor[reading], np.partition(score, n - best.k, axis=1)[:, n - best.k])
            row, vec = np.nonzero((score >= floor[reading][:, None]) & (score > -np.inf))
            out.append((reading[row], vec, score[row, vec]))
        query, vec, score = (np.concatenate(a) for a in zip(*out))
        keep = score >= floor[query]
        best.add(query[keep] + lo, ids[vec[keep]], score[keep].astype(np.int64))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k vectors of largest inner product with each query, itself left out.

    Both inputs are ``vec_id, dim, x`` as :func:`whole_components` makes them; only vectors
    of a query's own dimension are its candidates.  Ties go to the smaller vec_id; rows
    that share an id are candidates of their own, but never of a query with that id.
    """
    n = queries.count()
    qblocks = max(1, -(-n // QUERY_BLOCK))
    shares = 4 * cores(vectors)
    q = queries.withColumn("qblock", F.pmod(F.xxhash64("vec_id"), F.lit(qblocks)).cast("int"))
    q = q.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1)))).withColumn("is_query", F.lit(0))
    v = vectors.withColumn("share", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(shares)).cast("int"))
    v = v.withColumn("qblock", F.explode(F.sequence(F.lit(0), F.lit(qblocks - 1)))).withColumn("is_query", F.lit(1))
    both = q.unionByName(v).repartition(max(2, min(qblocks * shares, 4096)), "qblock", "share", "dim")
    both = both.sortWithinPartitions("qblock", "share", "dim", "is_query", "vec_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, best, qi, qx, ci, cx = None, None, [], [], [], []

        def flush() -> None:
            nonlocal best, ci, cx
            if best is None and qi:
                best = _Best(np.concatenate(qi), np.concatenate(qx), k)
            if best is not None and ci:
                ids, x = np.concatenate(ci), np.concatenate(cx)
                large = np.abs(x).max(axis=1, initial=0) >= LARGE
                for some in (large, ~large):
                    own, values = ids[some], x[some]
                    for lo in range(0, len(own), LIST_BLOCK):
                        _search(best, own[lo : lo + LIST_BLOCK], values[lo : lo + LIST_BLOCK])
            ci, cx = [], []

        def result() -> pa.RecordBatch:
            row, col = np.nonzero(best.real)
            arrays = [best.ids[row], best.vec[row, col], best.score[row, col]]
            return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["query_id", "vec_id", "score"])

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("qblock", "share", "dim", "is_query")], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
            ids = batch.column("vec_id").to_numpy()
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                if tuple(keys[lo, :3]) != key:
                    flush()
                    if best is not None:
                        yield result()
                    key, best, qi, qx = tuple(keys[lo, :3]), None, [], []
                dim = int(keys[lo, 2])
                x = batch.column("x").slice(lo, hi - lo).flatten().to_numpy(zero_copy_only=False).reshape(hi - lo, dim)
                (ci if keys[lo, 3] else qi).append(ids[lo:hi])
                (cx if keys[lo, 3] else qx).append(x)
                if sum(map(len, ci)) >= LIST_BLOCK:
                    flush()
        flush()
        if best is not None:
            yield result()

    found = both.select("qblock", "share", "dim", "is_query", "vec_id", "x").mapInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    score = F.when(F.col("score") > F.lit(UNDER), F.col("score")).otherwise(F.raise_error(F.lit("a score does not fit 64 bits")).cast("long"))
    return ranked.select("query_id", "rank", "vec_id", score.alias("score"))


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k best of all other vectors for every vector whose id is divisible by ``every``."""
    whole = store(whole_components(vectors, id_col, vector_col))
    return top_k(whole, whole.where(F.col("vec_id") % every == 0), k)
