"""Substrings of texts that may be keywords: rolling hashes of whole batches, looked up in a bitmap.

The bitmap holds a hash of every keyword.  A substring that it lacks is no keyword; one that it
has is most likely one, and only those leave the task, to be compared with the keywords.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_BITS, MOST_BITS = 1 << 15, 1 << 28
SPREAD = 32  # bits for each keyword, up to MOST_BITS
CHARS = 1 << 20  # of the texts that are hashed at once
BASE = 0x9E3779B97F4A7C15
MIXES = (0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)  # each word has a bit by each of them
INVERSE = pow(BASE, -1, 1 << 64)


class Hashes:
    """Hashes of any substring of the joined texts, from sums over their characters."""

    def __init__(self, texts: list[str]):
        self.joined = "".join(texts)
        codes = np.frombuffer(self.joined.encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1)
        self.ends = np.cumsum([len(t) for t in texts])
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * np.cumprod(np.full(len(codes), BASE, np.uint64)), out=self.sums[1:])
        self.back = np.cumprod(np.full(len(codes) + 1, INVERSE, np.uint64))

    def places(self, begins, ends, bits: int, mix: int) -> np.ndarray:
        """Places in a bitmap of ``bits`` bits; ``begins`` and ``ends`` are slices or arrays of positions."""
        hashes = (self.sums[ends] - self.sums[begins]) * self.back[begins]
        hashes ^= hashes >> np.uint64(32)
        return (hashes * np.uint64(mix) >> np.uint64(64 - bits.bit_length() + 1)).astype(np.int64)


def bitmap(words: DataFrame, column: str) -> np.ndarray:
    """Bits of all words, at most ``MOST_BITS``, whatever their number; Spark makes it in parts of 4 KB."""
    count, bits = words.count(), LEAST_BITS
    while bits < min(MOST_BITS, SPREAD * count):
        bits *= 2

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = Hashes(batch.column(0).to_pylist())
            begins = np.concatenate([[0], made.ends[:-1]]).astype(np.int64)
            at = np.concatenate([made.places(begins, made.ends, bits, mix) for mix in MIXES])
            yield pa.RecordBatch.from_arrays([pa.array(at + 1)], ["at"])

    placed = words.select(column).mapInArrow(hashed, "at long")
    parts = placed.groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("held"))
    held = np.zeros(bits // 8, np.uint8)
    for row in parts.collect():
        low = (row["bucket"] - 1) * 4096
        part = np.frombuffer(row["held"], np.uint8)[: len(held) - low]
        held[low : low + len(part)] = part
    return held


def _in(held: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.flatnonzero(held[at >> 3] >> (at & 7).astype(np.uint8) & 1)


def substrings(texts: list[str], lengths: list[int], held: np.ndarray) -> list[set[str]]:
    """Of every text the different substrings of these lengths that the bitmap has, and perhaps a few more."""
    out: list[set[str]] = [{""} if 0 in lengths else set() for _ in texts]
    made = Hashes(texts)
    size = len(made.joined)
    for n in lengths:
        if 0 < n <= size:
            hits = _in(held, made.places(slice(0, size - n + 1), slice(n, size + 1), 8 * len(held), MIXES[0]))
            for mix in MIXES[1:]:
                hits = hits[_in(held, made.places(hits, hits + n, 8 * len(held), mix))]
            of = np.searchsorted(made.ends, hits, side="right")
            inside = hits + n <= made.ends[of]
            for i, t in zip(hits[inside].tolist(), of[inside].tolist()):
                out[t].add(made.joined[i : i + n])
    return out


def find(texts: DataFrame, column: str, keys: list[str], words: DataFrame, word: str, piece: int) -> DataFrame:
    """``keys`` of a text and a substring ``word``, for all words that are inside it, and perhaps a few that are no words.

    Texts of more than ``piece`` characters are cut into pieces that overlap, so such a text may have a
    word twice.  NULL texts have none.  ``words`` is read three times.
    """
    lengths = sorted(r[0] for r in words.select(F.length(word)).distinct().collect())
    held = bitmap(words, word)
    step = piece + max(lengths, default=1)
    rows = texts.where(F.col(column).isNotNull()).select(*keys, column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for of, pieces in _runs(batch.column(len(keys)), piece, step):
                found = substrings(pieces, lengths, held)
                row = pa.array(np.repeat(np.array(of), [len(f) for f in found]))
                taken = [batch.column(k).take(row) for k in range(len(keys))]
                yield pa.RecordBatch.from_arrays([*taken, pa.array([w for f in found for w in f], pa.string())], [*keys, word])

    kinds = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys)
    return rows.mapInArrow(run, f"{kinds}, {word} string")


def _runs(texts: pa.Array, piece: int, step: int) -> Iterator[tuple[list[int], list[str]]]:
    """Pieces of the texts and the rows that they are of, some ``CHARS`` characters at once."""
    of, pieces, chars = [], [], 0
    for row, text in enumerate(texts):
        text = text.as_py()
        for low in range(0, max(1, len(text)), piece):
            of.append(row)
            pieces.append(text[low : low + step])
            chars += len(pieces[-1])
            if chars > CHARS:
                yield of, pieces
                of, pieces, chars = [], [], 0
    if of:
        yield of, pieces
