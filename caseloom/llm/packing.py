"""Best-fit packing of documents into fixed-length sequences, with matched large items.

Lengths are whole numbers up to the capacity, so the job is planned on how often each
length occurs: a table that the capacity bounds, however many documents there are.  The
plan says which ranks of a length go to which sequences; every document then finds its
place by its rank among those of its length.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseloom.llm.batches import cores, map_batches, texts
from caseloom.llm.tokens import KEPT_PIECES, encoder
from caseloom.session import store

SALTS = 64


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, keep_ids: bool = True, kept_pieces: int = KEPT_PIECES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and, if wanted, ``ids`` (little-endian 32-bit) of every document.

    The end id is appended to each document, a null text counting as empty.  Documents over
    the capacity are cut into pieces of full length, of which only the first may be shorter.
    """

    def cut(batch: pa.RecordBatch) -> pa.Table:
        enc = encoder(tokenizer, kept_pieces)
        out = defaultdict(list)
        ids_of = batch.column("doc_id").to_pylist()
        for doc_id, raw in zip(ids_of, enc.encode(batch.column("text").to_pylist())):
            ids = np.append(np.frombuffer(raw, enc.dtype).astype("<u4"), np.uint32(end_id)).astype("<u4")
            first = (len(ids) - 1) % capacity + 1
            bounds = [0, *range(first, len(ids) + 1, capacity)]
            for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
                part = ids[a:b].tobytes()
                for name, value in (("doc_id", doc_id), ("piece", i), ("start", a), ("length", b - a), ("ids_crc32", zlib.crc32(part))):
                    out[name].append(value)
                if keep_ids:
                    out["ids"].append(part)
        kinds = [batch.schema.field("doc_id").type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        return pa.table({n: pa.array(out[n], k) for n, k in zip(names, kinds)})

    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
    rows = texts(docs, id_col, text_col)
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long"
    return map_batches(rows, cut, schema + ", ids binary" * keep_ids, "text", using="tokens")


class _Bins:
    """Kinds of sequences: how many there are alike, and what each holds as ``(length, times)``."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.by_gap: dict[int, list[tuple[int, tuple]]] = defaultdict(list)

    def put(self, gap: int, count: int, held: tuple) -> None:
        if count:
            self.by_gap[gap].append((count, held))

    def take(self, size: int) -> tuple[int, int, tuple] | None:
        """Bins of the smallest gap that the length fits in."""
        for gap in range(size, self.capacity + 1):
            if self.by_gap.get(gap):
                return gap, *self.by_gap[gap].pop()
        return None

    def fill(self, size: int, count: int) -> None:
        """Best fit: each item goes to the fullest sequence that has room; a new one is opened if none has."""
        while count:
            gap, bins, held = self.take(size) or (self.capacity, count, ())
            each = gap // size
            full = min(bins, count // each)
            self.put(gap - each * size, full, (*held, (size, each)))
            count -= full * each
            if full < bins and count:
                last = min(count, each)
                self.put(gap - last * size, 1, (*held, (size, last)))
                count -= last
                full += 1
            if held:
                self.put(gap, bins - full, held)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, tuple]]:
    """Kinds of sequences ``(how many, ((length, times), …))`` for so many items of each length.

    Items over a third of the capacity come first, at most two to a sequence: from the
    longest down, each is matched with the longest other one that still fits beside it.
    The rest go, from the longest down, where the least room is left.
    """
    left = {s: n for s, n in counts.items() if n and 3 * s > capacity}
    bins = _Bins(capacity)
    sizes = sorted(left, reverse=True)
    for size in sizes:
        for mate in sizes:
            if left[size] and left[mate] and mate <= size and size + mate <= capacity:
                pairs = left[size] // 2 if mate == size else min(left[size], left[mate])
                held = ((size, 2),) if mate == size else ((size, 1), (mate, 1))
                bins.put(capacity - size - mate, pairs, held)
                left[size] -= pairs
                left[mate] -= pairs
        bins.put(capacity - size, left[size], ((size, 1),))
        left[size] = 0
    for size in sorted((s for s, n in counts.items() if n and 3 * s <= capacity), reverse=True):
        bins.fill(size, counts[size])
    return [kind for gap in sorted(bins.by_gap) for kind in bins.by_gap[gap]]


def _places(kinds: list[tuple[int, tuple]]) -> list[tuple[int, int, int, int, int, int]]:
    """For each length: ranks ``[lo, hi)`` go to sequences from ``first`` on, ``times`` to each, from offset ``base``."""
    out, used, first = [], defaultdict(int), 0
    for count, held in kinds:
        base = 0
        for size, times in held:
            lo = used[size]
            used[size] += count * times
            out.append((size, lo, used[size], first, times, base))
            base += size * times
        first += count
    return out


def pack(items: DataFrame, capacity: int = 1024) -> DataFrame:
    """``items`` (a ``length`` from 1 to ``capacity``, and an ``item`` key) with ``sequence_id`` and ``offset``.

    ``items`` is read several times; hand over a stored table.  Ranks are taken per length and
    salt, so that a length that a third of all items have is dealt to many tasks; which of
    several equal items comes first is of no consequence and follows their order.
    """
    salts = min(SALTS, 2 * cores(items))
    salted = items.withColumn("_salt", F.pmod(F.xxhash64("item"), F.lit(salts)).cast("int"))
    counts = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n")).collect()  # at most capacity x SALTS rows
    total, base = defaultdict(int), []
    for length, salt, n in sorted(counts):
        base.append((length, salt, total[length]))
        total[length] += n
    spark = items.sparkSession
    bases = spark.createDataFrame(base, "length long, _salt int, _base long")
    places = spark.createDataFrame(_places(plan(total, capacity)), "length long, _lo long, _hi long, _first long, _times long, _at long")
    order = Window.partitionBy("length", "_salt").orderBy("item")
    ranked = salted.withColumn("_rank", F.row_number().over(order) - 1)
    ranked = ranked.join(F.broadcast(bases), ["length", "_salt"]).withColumn("_rank", F.col("_rank") + F.col("_base"))
    placed = ranked.join(F.broadcast(places), "length").where("_rank >= _lo AND _rank < _hi")
    within = F.col("_rank") - F.col("_lo")
    return placed.select(
        *[c for c in items.columns],
        (F.col("_first") + F.floor(within / F.col("_times"))).cast("long").alias("sequence_id"),
        (F.col("_at") + within % F.col("_times") * F.col("length")).cast("long").alias("offset"),
    )


def packed(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, keep_ids: bool = True, kept_pieces: int = KEPT_PIECES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece of every document with its place: ``sequence_id`` and ``offset`` beside the columns of :func:`pieces`.

    Null texts are empty documents of one token; repeated rows are packed each on their own;
    a null id is kept; an empty table gives no rows.
    """
    cut = store(pieces(docs, tokenizer, capacity, end_id, keep_ids, kept_pieces, id_col, text_col))
    keyed = cut.withColumn("item", F.struct("doc_id", "piece", "ids_crc32"))
    return pack(keyed, capacity).drop("item")



def sequences(placed: DataFrame) -> DataFrame:
    """``sequence_id, ids``: the ids of each sequence, its pieces joined in the order of their offsets."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.expr("aggregate(parts, cast('' as binary), (a, x) -> a || x.ids)")
    return placed.groupBy("sequence_id").agg(parts.alias("parts")).select("sequence_id", joined.alias("ids"))
