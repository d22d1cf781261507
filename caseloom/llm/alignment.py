"""Alignment of the tokens that two tokenizers make of the same texts.

Inside a task the work is columnar: token ids are one flat array with the index of their
document beside it, token lengths become byte offsets by cumulative sums over each document,
and an Acero hash join of both sides on (document, end) finds the offsets at which tokens of
both end.  These cut the text into groups; tokens of a group are linked.  How many documents
link a pair of ids is counted by ``Table.group_by`` in each task and summed by Spark.

A document then needs the counts of its own pairs.  Of all pairs fewer than ``HOT`` can be
held by more than one ``HOT``-th of all (document, pair) rows; these are the ones that would
overload a task, and their table, which that proof bounds, goes to every task.  All others
are joined by a shuffle on the pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.batches import slices
from caseloom.llm.tokens import encoder
from caseloom.session import store

TEXT_BYTES = 1 << 20  # texts aligned at once, in a worker
KEPT_PIECES = 200_000
WIDE = 1 << 12  # links of a group that is counted by distinct ids instead of link by link
HOT = 1 << 17
PARTIAL_ROWS = 1 << 22
SPACE = "▁"


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies show a byte by its own printable character, all others by characters from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Both tokenizers with the bytes of their tokens; one per worker process."""

    def __init__(self, path_a: str, path_b: str):
        self.a = encoder(path_a, KEPT_PIECES, plain=True)
        byte = _byte_of_char()
        size = self.a.tokenizer.get_vocab_size()
        names = [self.a.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.bytes_a = pa.array([bytes(byte[c] for c in n) if all(c in byte for c in n) else b"" for n in names], pa.large_binary())
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        size = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(size)]
        special = [self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_unused(i) for i in range(size)]
        made = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else b"" if special[i] else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.bytes_b = pa.array(made, pa.large_binary())
        self.shown = pa.array([str(i) for i in range(max(len(self.bytes_a), size))])

    def encode_a(self, texts: list[str]) -> pa.ListArray:
        raw = self.a.encode(texts, lead=" ")
        step = self.a.dtype.itemsize
        offsets = np.cumsum([0, *(len(x) // step for x in raw)], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(raw), self.a.dtype).astype(np.int32)))

    def encode_b(self, texts: list[str]) -> pa.ListArray:
        ids = self.b.encode_as_numpy(texts, num_threads=1)  # a list object for each id would take longer than the ids
        offsets = np.cumsum([0, *map(len, ids)], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *ids]).astype(np.int32)))


_MADE: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _MADE:
        _MADE[path_a, path_b] = Aligner(path_a, path_b)
    return _MADE[path_a, path_b]


def _same_bytes(ids: pa.ListArray, vocabulary: pa.Array, wanted: list[bytes]) -> np.ndarray:
    """Which documents' joined token bytes are the wanted ones."""
    tokens = vocabulary.take(ids.flatten())
    ends = np.frombuffer(tokens.buffers()[1], np.int64)[: len(tokens) + 1]
    data = memoryview(tokens.buffers()[2] or b"").cast("B")
    cuts = ends[ids.offsets.to_numpy()].tolist()
    return np.array([len(w) == b - a and data[a:b] == w for a, b, w in zip(cuts, cuts[1:], wanted)], bool)


def _side(ids: pa.ListArray, vocabulary: pa.Array) -> pa.Table:
    """``doc, id, end`` of every token: its document in the batch and the byte offset where it ends there."""
    doc = pc.list_parent_indices(ids).cast(pa.int64())
    flat = ids.flatten()
    lengths = pc.binary_length(vocabulary).take(flat)
    total = np.concatenate([[0], pc.cumulative_sum(lengths).to_numpy()])
    begin = total[ids.offsets.to_numpy()[:-1]]
    end = total[1:] - begin[doc.to_numpy()]
    return pa.table({"doc": doc, "id": flat, "end": pa.array(end)})


def _groups(a: pa.Table, b: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """For each side, which of its tokens end where a token of the other ends: the ends of the groups."""
    keyed = [pa.table({"key": pc.add(pc.shift_left(t["doc"], 32), t["end"]), at: pa.array(np.arange(t.num_rows))}) for t, at in ((a, "a"), (b, "b"))]
    both = keyed[0].join(keyed[1], "key", join_type="inner", use_threads=False)
    return np.sort(both["a"].to_numpy()), np.sort(both["b"].to_numpy())


def _bounds(ends: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], ends + 1])


def _links(a: pa.Table, b: pa.Table, lo_a: np.ndarray, lo_b: np.ndarray, size_b: int) -> pa.Table:
    """``doc, pair, n``: how often each pair of ids is linked in a document; pair is a's id times ``size_b`` plus b's."""
    na, nb = np.diff(lo_a), np.diff(lo_b)
    ids_a, ids_b, doc = a["id"].to_numpy().astype(np.int64), b["id"].to_numpy().astype(np.int64), a["doc"].to_numpy()
    each = na * nb
    some = np.flatnonzero(each <= WIDE)
    times, of = each[some], np.repeat(some, each[some])
    within = np.arange(len(of)) - np.repeat(np.cumsum(times) - times, times)
    at_a = lo_a[of] + within // nb[of]
    at_b = lo_b[of] + within % nb[of]
    rows = [pa.table({"doc": doc[at_a], "pair": ids_a[at_a] * size_b + ids_b[at_b], "n": np.ones(len(of), np.int64)})]
    wide = np.flatnonzero(each > WIDE)
    if len(wide):
        sides = []
        for t, lo, name in ((a, lo_a, "a"), (b, lo_b, "b")):
            at = np.concatenate([np.arange(lo[g], lo[g + 1]) for g in wide.tolist()])
            own = pa.table({"group": np.repeat(wide, np.diff(lo)[wide]), name: t["id"].to_numpy()[at].astype(np.int64), "doc": t["doc"].to_numpy()[at]})
            sides.append(own.group_by(["group", "doc", name], use_threads=False).aggregate([([], "count_all")]).rename_columns(["group", "doc", name, f"n_{name}"]))
        met = sides[0].join(sides[1].drop_columns(["doc"]), "group", join_type="inner", use_threads=False)
        pair = pc.add(pc.multiply(met["a"], size_b), met["b"])
        rows.append(pa.table({"doc": met["doc"], "pair": pair, "n": pc.multiply(met["n_a"], met["n_b"])}))
    return pa.concat_tables(rows).group_by(["doc", "pair"], use_threads=False).aggregate([("n", "sum")]).rename_columns(["doc", "pair", "n"])


def _shown(a: pa.Table, b: pa.Table, lo_a: np.ndarray, lo_b: np.ndarray, of_doc: np.ndarray, names: pa.Array) -> list[str]:
    """For each document its groups as text, ``a1,a2|b1;a3|b2``."""
    sides = []
    for t, lo in ((a, lo_a), (b, lo_b)):
        listed = pa.ListArray.from_arrays(pa.array(lo, pa.int32()), names.take(t["id"].combine_chunks()))
        sides.append(pc.binary_join(listed, ","))
    groups = pc.binary_join_element_wise(*sides, "|")
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(of_doc, pa.int32()), groups), ";").to_pylist()


FIELDS = {"n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "groups_sha256": pa.string(), "pairs": pa.list_(pa.int64()), "times": pa.list_(pa.int64())}


def align(texts: list[str | None], tokenizers: Aligner) -> list[pa.Array]:
    """``FIELDS`` of each text: counts of tokens, groups and links, the digest of its groups, and its distinct
    linked pairs with how often each is linked."""
    n = len(texts)
    plain = [t or "" for t in texts]
    wanted = [(" " + t).encode() if t else b"" for t in plain]
    ids = [tokenizers.encode_a(plain), tokenizers.encode_b(plain)]
    words = [tokenizers.bytes_a, tokenizers.bytes_b]
    fine = np.array([bool(t) for t in plain], bool)
    for i, w in zip(ids, words):
        fine &= _same_bytes(i, w, wanted)
    kept = np.flatnonzero(fine)
    a, b = (_side(i.take(pa.array(kept)), w) for i, w in zip(ids, words))
    out = [np.zeros(n, np.int64) for _ in range(4)]
    digests, pairs, times = [""] * n, pa.array([[]] * n, FIELDS["pairs"]), pa.array([[]] * n, FIELDS["times"])
    if len(kept):
        ends_a, ends_b = _groups(a, b)
        lo_a, lo_b = _bounds(ends_a), _bounds(ends_b)
        each = np.diff(lo_a) * np.diff(lo_b)
        of_group = a["doc"].to_numpy()[ends_a]
        of_doc = np.searchsorted(of_group, np.arange(len(kept) + 1))
        total = np.concatenate([[0], np.cumsum(each)])
        made = [np.bincount(a["doc"].to_numpy(), minlength=len(kept)), np.bincount(b["doc"].to_numpy(), minlength=len(kept)), np.diff(of_doc), np.diff(total[of_doc])]
        for column, values in zip(out, made):
            column[kept] = values
        for k, shown in zip(kept.tolist(), _shown(a, b, lo_a, lo_b, of_doc, tokenizers.shown)):
            digests[k] = hashlib.sha256(shown.encode()).hexdigest()
        links = _links(a, b, lo_a, lo_b, len(tokenizers.bytes_b)).sort_by("doc")
        held = np.bincount(kept[links["doc"].to_numpy()], minlength=n)
        offsets = pa.array(np.concatenate([[0], np.cumsum(held)]), pa.int32())
        pairs, times = (pa.ListArray.from_arrays(offsets, links[c].combine_chunks()) for c in ("pair", "n"))
    return [*[pa.array(x) for x in out], pa.array(digests, pa.string()), pairs, times]


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times`` for every row of ``docs``."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", most=TEXT_BYTES, using="tokens"):
            made = align(batch.column("text").to_pylist(), aligner(path_a, path_b))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *made], ["doc_id", *FIELDS])

    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"
    return rows.mapInArrow(run, schema)


def pair_counts(rows: DataFrame, size_b: int) -> DataFrame:
    """``pair, n, best``: how many documents link a pair, and whether no other pair of its a id has more."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.Table] = []

        def counted() -> pa.Table:
            return pa.concat_tables(kept).group_by("pair", use_threads=False).aggregate([("n", "sum")]).rename_columns(["pair", "n"])

        for batch in batches:
            flat = batch.column("pairs").flatten()
            kept.append(pa.table({"pair": flat, "n": pa.array(np.ones(len(flat), np.int64))}))
            if sum(t.num_rows for t in kept) > PARTIAL_ROWS:
                kept = [counted()]
                if kept[0].num_rows > PARTIAL_ROWS // 2:  # hardly any repeat: let Spark have them
                    yield from kept.pop().to_batches()
        if kept:
            yield from counted().to_batches()

    counts = rows.select("pairs").mapInArrow(partial, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = store(counts.withColumn("a", F.expr(f"pair div {size_b}")))
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return store(counts.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")))


def _hot(counts: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs held by more than one ``HOT``-th of all rows: fewer than ``HOT``, as their shares add up to one."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    found = counts.where(F.col("n") * F.lit(HOT).cast("decimal(20,0)") > F.lit(total)).orderBy("pair").toPandas()
    return found["pair"].to_numpy(np.int64), found["n"].to_numpy(np.int64), found["best"].to_numpy(bool)


def _sums(rows: DataFrame, hot: tuple[np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    """The rows with ``best`` and ``total`` over their hot pairs, and ``cold``: the other pairs with their times."""
    pair, count, is_best = hot

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, times = batch.column("pairs"), batch.column("times").flatten().to_numpy()
            flat, of = pairs.flatten().to_numpy(), pc.list_parent_indices(pairs).to_numpy()
            at = np.minimum(np.searchsorted(pair, flat), max(0, len(pair) - 1))
            known = pair[at] == flat if len(pair) else np.zeros(len(flat), bool)
            sums = []
            for weight in (is_best, count):
                total = np.zeros(batch.num_rows, np.int64)
                np.add.at(total, of[known], weight[at[known]].astype(np.int64) * times[known])
                sums.append(pa.array(total))
            rest = ~known
            offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(of[rest], minlength=batch.num_rows))]), pa.int32())
            cold = [pa.ListArray.from_arrays(offsets, pa.array(x[rest])) for x in (flat, times)]
            names = [c for c in batch.schema.names if c not in ("pairs", "times")]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], *sums, *cold], [*names, "best", "total", "cold", "cold_times"])

    kept = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name not in ("pairs", "times")]
    return rows.mapInArrow(run, ", ".join([*kept, "best long", "total long", "cold array<long>", "cold_times array<long>"]))


def alignment(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    ``path_a`` is a byte-level file of ``tokenizers``, which gets a space before each text,
    ``path_b`` a model of ``sentencepiece``, which adds one itself.  n_best counts the links
    whose pair no other pair of the same a id exceeds in documents, ties included; count_sum
    adds the documents of all links' pairs.  Texts that are null, empty, or not given back by
    the bytes of both sides' tokens have no tokens: zeros and an empty digest.  Rows that
    repeat count each on their own, a null id is kept, very long texts are aligned whole, an
    empty table gives no rows.
    """
    size_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    rows = store(aligned(docs, path_a, path_b, id_col, text_col).withColumn("row", F.monotonically_increasing_id()))
    counts = pair_counts(rows, size_b)
    summed = store(_sums(rows, _hot(counts)))
    cold = summed.select("row", F.explode(F.arrays_zip("cold", "cold_times")).alias("x")).select("row", F.col("x.cold").alias("pair"), F.col("x.cold_times").alias("times"))
    found = cold.join(counts, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("cold_best"), F.sum(F.col("n") * F.col("times")).alias("cold_total")
    )
    all_best, all_total = (F.col(x) + F.coalesce(f"cold_{x}", F.lit(0)) for x in ("best", "total"))
    done = summed.join(found, "row", "left")
    return done.select("doc_id", "n_a", "n_b", "n_groups", "n_links", all_best.alias("n_best"), all_total.alias("count_sum"), "groups_sha256")
