"""Token ids in binary shards with a minimal perfect hash index for keyed access.

A shard is one file: a header, the raw ids of its documents one after another, and an
index.  The index keeps no keys: a minimal perfect hash takes a key to its slot, where a
fingerprint of the key, the place of the ids and their number are stored.  A key that is
not in the shard is told by its fingerprint (one in 2^32 passes by chance).

The hash is built in levels.  At each level the keys that are left go to a bit array by a
hash of their own; a position with exactly one key gets its bit, the others go on to the
next level.  A key's slot is the number of set bits before its own, so n keys have the
slots 0 to n-1 and a lookup reads one or two levels on average.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.batches import slices, texts
from caseloom.llm.tokens import encoder
from caseloom.session import shared_folder

MAGIC = b"IDSHARD1"
HEADER = struct.Struct("<8sIIQQQ")  # magic, bytes per id, levels, documents, ids, place of the index
SLOT = np.dtype([("fingerprint", "<u4"), ("n", "<u4"), ("start", "<u8")])
SHARD_IDS = 1 << 24


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & ((1 << 64) - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels  # of booleans
        ranks = [np.cumsum(bits) - bits for bits in levels]
        before = np.cumsum([0, *(int(bits.sum()) for bits in levels)])
        self.ranks = [r + b for r, b in zip(ranks, before)]

    @classmethod
    def build(cls, keys: np.ndarray, room: float = 1.5) -> PerfectHash:
        left, levels = keys.astype(np.uint64), []
        while len(left):
            at = _mix(left, len(levels)) % np.uint64(max(1, int(room * len(left))))
            count = np.bincount(at.astype(np.int64), minlength=max(1, int(room * len(left))))
            levels.append(count == 1)
            left = left[count[at.astype(np.int64)] > 1]
            if len(levels) > 200:
                raise ValueError("the keys are not distinct")
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for some of the keys that are not in it."""
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for i, bits in enumerate(self.levels):
            if not len(left):
                break
            at = (_mix(keys[left], i) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            out[left[hit]] = self.ranks[i][at[hit]]
            left = left[~hit]
        return out

    def to_bytes(self) -> bytes:
        return b"".join(struct.pack("<Q", len(b)) + np.packbits(b).tobytes() for b in self.levels)

    @classmethod
    def from_bytes(cls, raw: bytes, levels: int) -> tuple[PerfectHash, int]:
        at, out = 0, []
        for _ in range(levels):
            (n,) = struct.unpack_from("<Q", raw, at)
            size = (n + 7) // 8
            out.append(np.unpackbits(np.frombuffer(raw, np.uint8, size, at + 8), count=n).astype(bool))
            at += 8 + size
        return cls(out), at


def _key(ids: list, repeats: list[int]) -> np.ndarray:
    """64-bit keys of documents; a repeated or missing id is told apart by its ordinal."""
    plain = np.array([0 if i is None else i for i in ids], np.int64).view(np.uint64)
    nth = np.array(repeats, np.uint64)
    none = np.array([i is None for i in ids], np.uint64)
    return np.where((nth | none) == 0, plain, _mix(_mix(plain, 7) + (nth << np.uint64(1)) + none, 8))


def _ordinals(ids: list) -> list[int]:
    """How many equal ids stand before each."""
    out, seen = [], {}
    for i in ids:
        out.append(seen.get(i, 0))
        seen[i] = out[-1] + 1
    return out


def shard_bytes(ids: list, raws: list[bytes], dtype: np.dtype) -> bytes:
    """One shard of these documents, in this order."""
    keys = _key(ids, _ordinals(ids))
    counts = np.array([len(r) // dtype.itemsize for r in raws], np.int64)
    starts = np.cumsum(counts) - counts
    hashed = PerfectHash.build(keys)
    table = np.zeros(len(ids), SLOT)
    at = hashed.slots(keys)
    table["fingerprint"][at] = (_mix(keys, 99) >> np.uint64(32)).astype(np.uint32)
    table["n"][at], table["start"][at] = counts, starts
    payload = b"".join(raws)
    head = HEADER.pack(MAGIC, dtype.itemsize, len(hashed.levels), len(ids), int(counts.sum()), HEADER.size + len(payload))
    return head + payload + hashed.to_bytes() + table.tobytes()


class Shard:
    """Keyed reads of one shard file; each reads only the document's own ids."""

    def __init__(self, file: pa.NativeFile):
        self.file = file
        magic, size, levels, self.n_docs, self.n_ids, index = HEADER.unpack(file.read(HEADER.size))
        if magic != MAGIC:
            raise ValueError("not a shard of token ids")
        self.dtype = np.dtype(f"<u{size}")
        file.seek(index)
        raw = file.read()
        self.hash, at = PerfectHash.from_bytes(raw, levels)
        self.table = np.frombuffer(raw, SLOT, self.n_docs, at)

    def find(self, ids: list, repeats: list[int] | None = None) -> list[tuple[int, int] | None]:
        """Start and number of ids of each document, None for one that is not here."""
        if not ids or not self.n_docs:
            return [None] * len(ids)
        keys = _key(ids, repeats or [0] * len(ids))
        slots = self.hash.slots(keys)
        rows = self.table[np.maximum(slots, 0)]
        ok = (slots >= 0) & (rows["fingerprint"] == (_mix(keys, 99) >> np.uint64(32)).astype(np.uint32))
        return [(int(r["start"]), int(r["n"])) if y else None for r, y in zip(rows, ok)]

    def ids(self, start: int, n: int) -> np.ndarray:
        self.file.seek(HEADER.size + start * self.dtype.itemsize)
        return np.frombuffer(self.file.read(n * self.dtype.itemsize), self.dtype)


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri))


def open_shard(path: str) -> Shard:
    at, inner = file_system(path)
    return Shard(at.open_input_file(inner))


def write_shards(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, shards: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the ids of ``docs`` in ascending key order and returns the manifest, one row per shard.

    ``shard`` (their order), ``path, n_docs, n_ids, lo, hi`` (smallest and largest key), and
    ``base``, the number of ids in all shards before.  ``folder`` is one that every machine
    reaches.  Rows are dealt by ranges of the key, equal keys by their text; a task may write
    several shards.  A file gets its name only when it is whole and the manifest names the
    files of the tasks that succeeded, so repeated tasks do no harm.  Null texts are empty
    (only the end id); null keys come first; equal keys are ordered by text.
    """
    rows = texts(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    parts = shards or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(parts, "doc_id", "tie")
    ordered = ordered.sortWithinPartitions("doc_id", "tie", "text").drop("tie")
    folder = folder.rstrip("/")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(tokenizer), TaskContext.get().partitionId()
        end = np.array([end_id], enc.dtype).tobytes()
        at, inner = file_system(folder)
        at.create_dir(inner, recursive=True)
        ids, raws, size, made = [], [], 0, 0

        def flush() -> pa.RecordBatch:
            name = f"shard-{part:06d}-{made:04d}-{uuid4().hex[:12]}.ids"
            with at.open_output_stream(f"{inner}/_{name}") as f:
                f.write(shard_bytes(ids, raws, enc.dtype))
            at.move(f"{inner}/_{name}", f"{inner}/{name}")
            row = {"part": part, "nth": made, "path": f"{folder}/{name}", "n_docs": len(ids), "n_ids": size, "lo": ids[0], "hi": ids[-1]}
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in slices(batches, "text", using="tokens"):
            new = batch.column("doc_id").to_pylist()
            for doc_id, raw in zip(new, enc.encode(batch.column("text").to_pylist())):
                ids.append(doc_id)
                raws.append(raw + end)
                size += len(raws[-1]) // enc.dtype.itemsize
                if size >= SHARD_IDS:
                    yield flush()
                    ids, raws, size, made = [], [], 0, made + 1
        if ids:
            yield flush()

    kinds = {"part": pa.int32(), "nth": pa.int32(), "path": pa.string(), "n_docs": pa.int64(), "n_ids": pa.int64(), "lo": pa.int64(), "hi": pa.int64()}
    schema = pa.schema(list(kinds.items()))
    manifest = ordered.mapInArrow(write, "part int, nth int, path string, n_docs long, n_ids long, lo long, hi long")
    path = f"{folder}/manifest-{uuid4().hex[:12]}"
    manifest.write.parquet(path)
    spark = docs.sparkSession
    return spark.read.parquet(path)


def with_bases(manifest: DataFrame) -> list[dict]:
    """The manifest in order, with ``base``: one small entry per shard of 16 million ids."""
    out, base = [], 0
    for r in manifest.orderBy("part", "nth").collect():
        out.append(r.asDict() | {"base": base})
        base += r["n_ids"]
    return out


def read_documents(docs: DataFrame, manifest: DataFrame, id_col: str = "doc_id", keep_ids: bool = False) -> DataFrame:
    """The documents of ``docs`` (keys only) as the files have them: ``doc_id, start, n_tokens, ids_crc32``.

    start counts the ids of all documents before; ids_crc32 is over the ids as little-endian
    32-bit numbers; ``ids`` holds them if wanted.  Each key goes to the shards whose range it
    falls in and is looked up there by the index.  Keys that no shard has give no row.
    """
    spark = docs.sparkSession
    entries = with_bases(manifest)
    for i, e in enumerate(entries):
        e["shard"] = i
    if not entries:
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * keep_ids)
    listed = spark.createDataFrame([(e["shard"], e["path"], e["base"]) for e in entries], "shard int, path string, base long")
    los = [e["lo"] for e in entries]
    edges = np.array([np.iinfo(np.int64).min if x is None else x for x in los], np.int64)
    tops = np.array([np.iinfo(np.int64).min if e["hi"] is None else e["hi"] for e in entries], np.int64)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            plain = np.array([np.iinfo(np.int64).min if i is None else i for i in ids.to_pylist()], np.int64)
            first = np.searchsorted(tops, plain, side="left")
            last = np.searchsorted(edges, plain, side="right")
            n = np.maximum(last - first, 0)
            take = np.repeat(np.arange(len(plain)), n)
            shard = np.concatenate([np.arange(a, b) for a, b in zip(first, last)] or [[]]).astype(np.int32)
            arrays = [ids.take(pa.array(take)), pa.array(shard), batch.column("n").take(pa.array(take))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "shard", "n"])

    keys = docs.groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.count("*").alias("n"))
    routed = keys.mapInArrow(route, "doc_id long, shard int, n long")
    grouped = routed.join(F.broadcast(listed), "shard") if len(entries) < 10_000 else routed.join(listed, "shard")
    parts = grouped.repartition(len(entries), "shard").sortWithinPartitions("shard", "doc_id")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, shard = None, None
        for batch in batches:
            n = batch.column("n").to_numpy()
            rows = np.repeat(np.arange(len(n)), n)
            nth = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
            wanted = batch.take(pa.array(rows))
            ids_of, paths, bases = (wanted.column(c).to_pylist() for c in ("doc_id", "path", "base"))
            cuts = [0, *(i for i in range(1, len(paths)) if paths[i] != paths[i - 1]), len(paths)]
            out = {f.name: [] for f in schema}
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                if paths[lo] != path:
                    if shard is not None:
                        shard.file.close()
                    path, shard = paths[lo], open_shard(paths[lo])
                for doc_id, place in zip(ids_of[lo:hi], shard.find(ids_of[lo:hi], nth[lo:hi].tolist())):
                    if place is None:  # of repeated keys, some are in another shard
                        continue
                    ids = shard.ids(*place).astype("<u4")
                    row = (doc_id, bases[lo] + place[0], place[1], zlib.crc32(ids.tobytes()), ids.astype(np.int64))
                    for c, v in zip(out, row):
                        out[c].append(v)
            yield pa.RecordBatch.from_pydict(out, schema)

    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    schema = pa.schema(fields + [("ids", pa.list_(pa.int64()))] * keep_ids)
    return parts.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * keep_ids)


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 0, folder: str | None = None, keep_ids: bool = False) -> DataFrame:
    """Writes ``docs`` to shards in the shared folder and reads every document back by its key."""
    at = folder or f"{shared_folder(docs.sparkSession)}/caseloom/shards-{uuid4().hex}"
    return read_documents(docs, write_shards(docs, at, tokenizer, end_id), keep_ids=keep_ids)
