"""Substring deduplication by relative Lempel-Ziv parsing against indexed reference blocks.

Every document is cut into reference blocks at places that its words themselves choose, so
that equal passages are cut alike wherever they stand: the anchor of a window of ``window``
words is the smallest hash among its runs of ``run`` words, and a block is the span of all
successive windows that share one anchor.  The index takes a block to the smallest document
that has it.

Parsing goes from block to block.  As long as the blocks of a document are found whole in
smaller documents, the current factor grows; blocks overlap by a window, so a factor's
spans are exactly the passages of at least ``window`` words that smaller documents have.
Where a factor ends, the block there shares its anchor with other blocks but differs from
them somewhere: its windows are checked one by one against the windows of those blocks.
Only these boundary windows are ever shuffled; all others are settled by whole blocks.

A window that a smaller document has is found: it has the same anchor there, so its block
there either equals this one or is one of those whose windows are compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.batches import slices
from caseloom.session import store

RUN = 10
_BASE_BYTE, _BASE_WORD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least n of each."""
    known = _POWERS.get(int(base))
    if known is None or len(known[0]) < n:
        n = max(n, 1 << 16)
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        out = []
        for b in (base, inverse):
            p = np.full(n, b, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        known = _POWERS[int(base)] = tuple(out)
    return known


class _Sums:
    """Hashes of any spans of a sequence of 64-bit numbers."""

    def __init__(self, values: np.ndarray, base: np.uint64):
        self.up, self.down = _powers(base, len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[: len(values)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return _mix((self.sums[ends] - self.sums[starts]) * self.down[starts])


def _words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of some bytes: what stands between spaces, tabs and line ends."""
    space = np.ones(len(raw) + 2, bool)
    space[1:-1] = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.flatnonzero(space[1:] != space[:-1])
    return edge[::2], edge[1::2]


class Parsed:
    """Words, windows and blocks of one text."""

    def __init__(self, text: str | None, window: int, run: int = RUN):
        self.raw = (text or "").encode()
        data = np.frombuffer(self.raw, np.uint8)
        self.starts, self.ends = _words(data)
        self.n = len(self.starts)
        self.window = window
        self.windows = max(0, self.n - window + 1)
        self.first = np.zeros(0, np.int64)  # first window of each block
        if not self.windows:
            return
        with np.errstate(over="ignore"):
            words = _Sums(data.astype(np.uint64) + np.uint64(1), _BASE_BYTE).of(self.starts, self.ends)
            self.words = _Sums(words, _BASE_WORD)
            at = np.arange(self.n - run + 1)
            runs = self.words.of(at, at + run)
        # the smallest run of each window, the leftmost of equals: blockwise prefix and suffix minima
        wide = window - run + 1
        packed = (runs >> np.uint64(28) << np.uint64(28)) | at.astype(np.uint64)
        pad = -len(packed) % wide
        grid = np.concatenate([packed, np.full(pad, ~np.uint64(0))]).reshape(-1, wide)
        left = np.minimum.accumulate(grid, axis=1).ravel()
        right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        w = np.arange(self.windows)
        lowest = (np.minimum(right[w], left[w + wide - 1]) & np.uint64((1 << 28) - 1)).astype(np.int64)
        self.first = np.flatnonzero(np.concatenate([[True], lowest[1:] != lowest[:-1]]))
        self.last = np.concatenate([self.first[1:] - 1, [self.windows - 1]])
        anchor = lowest[self.first]
        with np.errstate(over="ignore"):
            self.anchors = runs[anchor].view(np.int64)
            spans = self.words.of(self.first, self.last + window)
            self.blocks = _mix(spans + (anchor - self.first).astype(np.uint64) * _BASE_BYTE).view(np.int64)

    def window_hashes(self, at: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return self.words.of(at, at + self.window).view(np.int64)

    def covered(self, windows: np.ndarray) -> np.ndarray:
        """Which words stand in one of these windows."""
        change = np.zeros(self.n + 1, np.int64)
        np.add.at(change, windows, 1)
        np.add.at(change, windows + self.window, -1)
        return np.cumsum(change[:-1]) > 0

    def kept(self, gone: np.ndarray) -> bytes:
        keep = np.flatnonzero(~gone)
        return b" ".join([self.raw[a:b] for a, b in zip(self.starts[keep].tolist(), self.ends[keep].tolist())])


def blocks(docs: DataFrame, window: int) -> DataFrame:
    """``doc_id, anchor, block`` of every block of every document that has an id."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            ids, anchors, found = [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                p = Parsed(text, window)
                if p.windows and doc_id is not None:
                    ids.append(np.full(len(p.first), doc_id, np.int64))
                    anchors.append(p.anchors)
                    found.append(p.blocks)
            if ids:
                arrays = [pa.array(np.concatenate(x)) for x in (ids, anchors, found)]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "anchor", "block"])

    return docs.mapInArrow(cut, "doc_id long, anchor long, block long")


def settled(cut: DataFrame) -> DataFrame:
    """``doc_id, anchor, block, found`` for blocks whose anchor stands in more than one kind of block or document.

    found: a smaller document has the whole block.  The others are boundaries, and only the
    smallest document of each such block is one; their windows have to be compared.
    """
    kinds = cut.groupBy("anchor", "block").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("top"))
    of_anchor = kinds.groupBy("anchor").agg(F.min("block").alias("lo"), F.max("block").alias("hi"))
    many = kinds.join(of_anchor, "anchor").where("lo <> hi OR owner <> top")
    index = many.select("anchor", "block", "owner", (F.col("lo") != F.col("hi")).alias("differs"))
    met = cut.join(index, ["anchor", "block"]).where("owner < doc_id OR differs")
    return met.select("doc_id", "anchor", "block", (F.col("owner") < F.col("doc_id")).alias("found"))


def remove_repeats(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True, carry: tuple[str, ...] = ()) -> DataFrame:
    """Removes every word in a window that a document with a smaller id has too, judged on the input.

    One row per row of ``docs``: ``doc_id, n_words, n_removed, kept_sha256`` (of the kept words
    joined by one space) and, if wanted, ``text``: the kept words where some were removed, else
    the text as it was, and the columns ``carry`` of ``docs`` in a struct ``rest``.  Null texts have no words.  Rows without an id lose nothing and take
    nothing from others; rows with the same id lose what smaller ids have, not each other's.
    Hashes of 64 bits stand for windows, of 128 for blocks.
    """
    rest = F.struct(*[F.col(c) for c in carry]) if carry else F.lit(None).cast("int")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), rest.alias("rest"))
    met = settled(store(blocks(rows.select("doc_id", "text"), window)))
    marks = met.groupBy("doc_id").agg(
        F.collect_set(F.when(F.col("found"), F.struct("anchor", "block"))).alias("found"),
        F.collect_set(F.when(~F.col("found"), F.struct("anchor", "block"))).alias("open"),
    )
    parsed = store(_parse(rows.join(marks, "doc_id", "left"), window))
    bounds = parsed.where("size(hashes) > 0").select("doc_id", F.explode("hashes").alias("hash"))
    owners = bounds.groupBy("hash").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("top")).where("owner < top")
    hits = bounds.join(owners, "hash").where("owner < doc_id").groupBy("doc_id").agg(F.collect_set("hash").alias("hit"))
    whole = parsed.where("size(hashes) = 0").select("doc_id", "n_words", "n_removed", "kept_sha256", "text", "rest")
    last = _finish(parsed.where("size(hashes) > 0").join(hits, "doc_id", "left"), window)
    done = whole.union(last).drop(*[] if carry else ["rest"])
    return done if keep_text else done.drop("text")


def _pairs(value) -> set[tuple[int, int]]:
    return {(x["anchor"], x["block"]) for x in value or ()}


def _of_blocks(p: Parsed, wanted: set[tuple[int, int]]) -> np.ndarray:
    """The windows of those blocks, in order."""
    if not wanted or not p.windows:
        return np.zeros(0, np.int64)
    own = zip(p.anchors.tolist(), p.blocks.tolist(), p.first.tolist(), p.last.tolist())
    found = [np.arange(a, b + 1) for x, y, a, b in own if (x, y) in wanted]
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def _result(p: Parsed, text: str | None, gone: np.ndarray) -> dict:
    kept = p.kept(gone)
    removed = int(gone.sum())
    new = kept.decode() if removed else text
    return {"n_words": p.n, "n_removed": removed, "kept_sha256": hashlib.sha256(kept).hexdigest(), "text": new}


_FIELDS = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("text", pa.string())]
_SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string, text string"


def _map_rows(rows: DataFrame, fn: Callable[[dict], dict], fields: list, schema: str) -> DataFrame:
    """One row of ``fields`` for each row, ``rest`` handed through as it is."""
    shape = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rest = batch.column("rest")
            plain = batch.drop_columns(["rest"])
            made = pa.RecordBatch.from_pylist([fn(row) for row in plain.to_pylist()], shape)
            yield made.append_column("rest", rest)

    return rows.mapInArrow(run, f"{schema}, rest {rows.schema['rest'].dataType.simpleString()}")


def _parse(rows: DataFrame, window: int) -> DataFrame:
    """Factors of every document; those with boundaries keep their text, covered windows and boundary hashes."""

    def parse(row: dict) -> dict:
        p = Parsed(row["text"], window)
        covered = _of_blocks(p, _pairs(row["found"]))
        edge = _of_blocks(p, _pairs(row["open"]))
        base = {"doc_id": row["doc_id"], "covered": [], "hashes": []}
        if len(edge):
            return base | {"text": row["text"], "covered": covered, "hashes": np.unique(p.window_hashes(edge))}
        return base | _result(p, row["text"], p.covered(covered) if p.n else np.zeros(0, bool))

    fields = [*_FIELDS, ("covered", pa.list_(pa.int32())), ("hashes", pa.list_(pa.int64()))]
    return _map_rows(rows, parse, fields, _SCHEMA + ", covered array<int>, hashes array<long>")


def _finish(rows: DataFrame, window: int) -> DataFrame:
    """Results of the documents with boundaries, their windows that were hit known."""

    def finish(row: dict) -> dict:
        p = Parsed(row["text"], window)
        hit = np.array(row["hit"] or [], np.int64)
        edge = np.flatnonzero(np.isin(p.window_hashes(np.arange(p.windows)), hit)) if len(hit) else hit
        gone = p.covered(np.concatenate([np.array(row["covered"] or [], np.int64), edge]))
        return {"doc_id": row["doc_id"]} | _result(p, row["text"], gone)

    return _map_rows(rows.select("doc_id", "text", "covered", "hit", "rest"), finish, _FIELDS, _SCHEMA)
