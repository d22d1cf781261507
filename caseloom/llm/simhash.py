"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at distance ``2 r`` or less have a variant within ``r`` flipped bits of
both in common, so every fingerprint emits its ball of variants and equal variants meet
in one group.  All members of such a group lie within ``2 r`` of each other: a star from
its smallest member stands for all pairs, and the group holds at most one ball of
distinct fingerprints, however large the table is.

A ball of radius 2 has 2,081 variants.  Fingerprints that cannot have a partner are kept
from emitting theirs by the same idea on parts of the bits (:func:`with_partners`).
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseloom.llm.batches import map_batches, texts
from caseloom.session import store

BITS = 64
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shingle_hashes(text: str | None, shingle: int = 4) -> np.ndarray:
    """The 64-bit hash of each shingle of a text, in order; none without words."""
    words = text.encode().translate(LOWER).split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], 42) for a, b in zip(starts.tolist(), ends[k - 1 :].tolist())], "<u8")


def print_of(hashes: np.ndarray) -> int:
    """64 bits, each set if it is set in over half of the hashes; zero without any."""
    if not len(hashes):
        return 0
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    over = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(over, bitorder="little").view("<u8")[0])


def simhash(text: str | None, shingle: int = 4) -> int:
    """64 bits, each set if it is set in over half of the shingles' hashes; zero without words."""
    return print_of(shingle_hashes(text, shingle))


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp`` for every row of ``docs``; a null text counts as empty, whose fingerprint is zero."""

    def prints(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = np.array([simhash(t, shingle) for t in batch.column("text").to_pylist()], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(made)], ["doc_id", "fp"])

    rows = texts(docs, id_col, text_col)
    return map_batches(rows, prints, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long", "text")


def _ball(bits: list[int], radius: int) -> np.ndarray:
    """What to flip for each variant within ``radius`` of those bits."""
    return np.array([sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(bits, r)], np.uint64)


def _emit(fps: DataFrame, masks: list[tuple[int, np.ndarray]]) -> DataFrame:
    """``part, variant, fp``: for each part, the fingerprint's kept bits under every flip."""

    def variants(batch: pa.RecordBatch) -> pa.RecordBatch:
        fp = batch.column("fp").to_numpy(zero_copy_only=False)
        made, part = [], []
        for i, (keep, flips) in enumerate(masks):
            made.append(((fp.view(np.uint64) & np.uint64(keep))[:, None] ^ flips[None, :]).ravel())
            part.append(np.full(len(made[-1]), i, np.int32))
        fps_of = np.concatenate([np.repeat(fp, len(flips)) for _, flips in masks])
        arrays = [np.concatenate(part), np.concatenate(made).view(np.int64), fps_of]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], ["part", "variant", "fp"])

    size = sum(len(flips) for _, flips in masks)

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, step := max(1, (1 << 18) // size)):
                yield variants(batch.slice(lo, step))

    return fps.mapInArrow(run, "part int, variant long, fp long")


def with_partners(fps: DataFrame, radius: int) -> DataFrame:
    """The distinct fingerprints ``fp`` that may have another within ``radius``; none that has one is left out.

    The bits are dealt to three parts.  Of a pair within the radius, the two parts that differ
    least hold at most two thirds of the differing bits, so these parts' bits meet in the
    middle of a ball a third of the radius wide: 131 short-lived rows instead of 2,081.
    """
    parts = [list(range(i * BITS // 3, (i + 1) * BITS // 3)) for i in range(3)]
    masks = []
    for i in range(3):
        kept = [b for j in range(3) if j != i for b in parts[j]]
        masks.append((sum(1 << b for b in kept), _ball(kept, -(-(radius * 2 // 3) // 2))))
    group = Window.partitionBy("part", "variant")
    met = _emit(fps, masks).select("fp", F.min("fp").over(group).alias("lo"), F.max("fp").over(group).alias("hi"))
    return met.where("lo <> hi").select("fp").distinct()


def links(fps: DataFrame, radius: int = 4, prune: bool = True) -> DataFrame:
    """Links ``a < b`` that join the same fingerprints as all pairs of distinct ``fp`` within ``radius`` bits.

    Every group of equal variants gives its smallest member's links to the others.
    """
    if radius % 2:
        raise ValueError("the radius is met in the middle, so it must be even")
    some = store(with_partners(fps, radius)) if prune else fps
    every = list(range(BITS))
    met = _emit(some, [((1 << BITS) - 1, _ball(every, radius // 2))])
    met = met.select(F.min("fp").over(Window.partitionBy("variant")).alias("a"), F.col("fp").alias("b"))
    found = met.where("a <> b").distinct()
    return found.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def components(pairs: DataFrame) -> DataFrame:
    """``node, root`` for every node of the links ``a, b``; root is the smallest node reachable.

    Alternates stars around larger and smaller neighbours until the links are stars.  Each
    round is two aggregates with a join back and is written to the shared folder.
    """

    def stars(edges: DataFrame) -> DataFrame:
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        moved = large.join(low, "b").select(F.col("m"), F.col("a")).where("a <> m")
        return moved.union(low.select("m", "b")).toDF("a", "b").distinct()

    def sign(edges: DataFrame):
        return edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()

    edges = store(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct())
    last = sign(edges)
    while last[0]:
        edges = store(stars(edges))
        now = sign(edges)
        if now == last:
            break
        last = now
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
        edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fingerprint`` (16 hex digits) and ``component_id``.

    component_id is the smallest doc_id among all documents reachable over links of at most
    ``radius`` differing bits, the document's own included.  Null texts count as empty;
    documents without words have fingerprint zero and are linked like any others; null ids
    are passed over when the smallest is taken; repeated rows are kept.  No rows, no result.
    """
    rows = store(fingerprints(docs, shingle, id_col, text_col))
    distinct = store(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(distinct.select("fp"), radius))
    known = distinct.join(roots, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp"))
    named = known.groupBy("root").agg(F.min("first").alias("component_id"))
    of_fp = known.select("fp", "root").join(named, "root").select("fp", "component_id")
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return rows.join(of_fp, "fp").select("doc_id", hexed.alias("fingerprint"), "component_id")
