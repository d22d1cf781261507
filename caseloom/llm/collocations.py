"""Phrase collocations of two and three words by best-first branch and bound.

A phrase cut in two parts scores ``a * a / (l * r)``, a its own count and l, r those of its
parts; its worst cut counts.  Counts never grow as a phrase grows, so what is known of a
prefix bounds all that may grow from it: a word occurs at least as often as any phrase that
begins with it, so only words of ``least`` occurrences grow at all; and a phrase that begins
with the pair w1 w2 scores at most ``f(w1 w2) / f(w1)`` (its rest after w1 occurs at least as
often as itself).

Pairs are counted over all words that may grow and are then the frontier.  Of each language,
those whose bound reaches a threshold are expanded by one more reading of the texts, together
with the pairs whose own score reaches it, on both sides, since a longer phrase may drop them.
Everything that scores the threshold or more is then known.  The first threshold is the score
of a pair a little beyond the wanted rank; where fewer phrases survive, the threshold falls
and the language goes on, until the wanted rank and all its ties are settled or nothing is
left to expand.

Tasks are told what to expand by bitmaps of hashes, whose size has a limit: a wrong hit only
counts a phrase that scores too little, or occurs too seldom, and goes again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseloom.session import store

CHUNK_BYTES = 8 << 20  # texts counted together, in a worker
LEAST_BITS, MOST_BITS = 1 << 15, 1 << 28
SPREAD = 16  # bits for each entry, up to MOST_BITS
SLACK, GROWTH, LAST_RANK = 1.5, 4, 100_000  # ranks of the thresholds; beyond the last everything is expanded
SHARES = 16  # of a language's phrases when they are ranked
SCALE = 1_000_000
UNKNOWN = "und"
#: A-Z in lower case, tabs as spaces, and all that ends a piece as line ends.
_TABLE = bytes(10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_MUL = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * _MUL[3]
        x = (x ^ (x >> np.uint64(29))) * _MUL[0]
        return x ^ (x >> np.uint64(32))


def _hashes(words: list[bytes], lang: str) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang)
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in words], np.uint64)


def _pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mix(first * _MUL[1] + second * _MUL[2])


class Bits:
    """A set of hashes as a bitmap; ``in`` may be wrong for what is not in the set, never for what is."""

    def __init__(self, size: int, held: np.ndarray):
        self.size, self.held = size, held  # one byte for eight positions, the lowest bit first

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & np.uint64(self.size - 1)
        return (self.held[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bits(phrases: DataFrame, words: list[str]) -> Bits:
    """The bitmap of the phrases' hashes: at most ``MOST_BITS`` bits, whatever their number; phrases have ``lang`` and these word columns."""
    count = phrases.count()
    size = LEAST_BITS
    while size < min(MOST_BITS, SPREAD * count):
        size *= 2

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            at = np.zeros(batch.num_rows, np.uint64)
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                rows = np.flatnonzero(langs.indices.to_numpy() == k)
                own = [_hashes(batch.column(w).take(pa.array(rows)).cast(pa.binary()).to_pylist(), lang) for w in words]
                at[rows] = own[0] if len(own) == 1 else _pair_hashes(*own)
            yield pa.RecordBatch.from_arrays([pa.array((at & np.uint64(size - 1)).astype(np.int64))], ["at"])

    placed = phrases.select("lang", *words).mapInArrow(place, "at long")
    # positions of a bitmap are counted from 1 on
    part = placed.groupBy(F.bitmap_bucket_number(F.col("at") + 1).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("at") + 1)).alias("held"))
    held = np.zeros(size // 8, np.uint8)
    for row in part.collect():  # at most MOST_BITS / 32,768 rows of 4 KB
        at = (row["bucket"] - 1) * 4096
        held[at : at + 4096] = np.frombuffer(row["held"], np.uint8)[: size // 8 - at]
    return Bits(size, held)


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values, n = np.unique(keys, return_counts=True)
    return values, n


class _Words:
    """All words of some texts of one language in order, as numbers; -1 where a piece ends."""

    def __init__(self, texts: list[bytes], lang: str):
        whole = b"\n".join(texts).translate(_TABLE).replace(b"\n", b" \n ")
        coded = pc.split_pattern(pa.array([whole], pa.large_binary()), b" ").values.dictionary_encode()
        names, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
        number = np.full(len(names) + 1, -2, np.int64)
        own = [i for i, w in enumerate(names) if w not in (b"", b"\n")]
        number[own] = np.arange(len(own))
        number[[i for i, w in enumerate(names) if w == b"\n"]] = -1
        codes = number[codes]
        self.codes, self.lang = codes[codes != -2], lang
        self.names = [names[i] for i in own]
        self.table = pa.array(self.names, pa.binary())

    def rows(self, columns: list[np.ndarray], n: np.ndarray) -> pa.RecordBatch:
        arrays = [pa.array([self.lang] * len(n), pa.string()), *[self.table.take(pa.array(c)) for c in columns], pa.array(n, pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, ["lang", *[f"w{i + 1}" for i in range(len(columns))], "n"])

    def singles(self) -> pa.RecordBatch:
        every, n = _counted(self.codes[self.codes >= 0])
        return self.rows([every], n)

    def pairs(self, growing: Bits) -> pa.RecordBatch:
        """Pairs of words that may grow."""
        fine = np.append(growing.has(_hashes(self.names, self.lang)), False)
        a, b = self.codes[:-1], self.codes[1:]
        some = np.flatnonzero(fine[a] & fine[b])  # -1 finds the last entry
        size = max(1, len(self.names))
        keys, n = _counted(a[some] * size + b[some])
        return self.rows([keys // size, keys % size], n)

    def triples(self, often: Bits, frontier: Bits, contested: Bits) -> pa.RecordBatch:
        """Words in threes whose pairs both occur often, the first in the frontier or the second contested."""
        size = max(1, len(self.names))
        a, b = self.codes[:-1], self.codes[1:]
        at = np.flatnonzero((a >= 0) & (b >= 0))
        keys, number = np.unique(a[at] * size + b[at], return_inverse=True)
        hashes = _hashes(self.names, self.lang)
        hashes = _pair_hashes(hashes[keys // size], hashes[keys % size])
        fine = often.has(hashes)
        first, second = fine & frontier.has(hashes), fine & contested.has(hashes)
        pair = np.full(len(self.codes), -1, np.int64)
        pair[at] = number
        x, y = pair[:-1], pair[1:]
        both = np.flatnonzero((x >= 0) & (y >= 0))
        x, y = x[both], y[both]
        some = fine[x] & fine[y] & (first[x] | second[y])
        found, n = _counted(x[some] * size + self.codes[both[some] + 2])
        pairs = keys[found // size]
        return self.rows([pairs // size, pairs % size, found % size], n)


def _count(texts: DataFrame, length: int, make) -> DataFrame:
    """``lang, w1 …, n``: what ``make`` counts in the words of each chunk of texts, summed up."""
    words = [f"w{i + 1}" for i in range(length)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size = 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                held.setdefault(lang, []).append(text)
                size += len(text)
                if size >= CHUNK_BYTES:
                    yield from (make(_Words(t, x)) for x, t in held.items())
                    held, size = {}, 0
        yield from (make(_Words(t, x)) for x, t in held.items())

    schema = ", ".join(["lang string", *[f"{w} binary" for w in words], "n long"])
    made = texts.mapInArrow(run, schema).groupBy("lang", *words).agg(F.sum("n").alias("n"))
    return made.select("lang", *[F.col(w).cast("string").alias(w) for w in words], "n")


def _score(a: str, left: str, right: str):
    """floor(1,000,000 a a / (l r)) in decimals of 38 digits: right for counts up to 10^16."""
    wide = [f"cast({c} as decimal(38,0))" for c in (a, left, right)]
    return F.expr(f"(cast({SCALE} as decimal(38,0)) * {wide[0]} * {wide[0]}) div ({wide[1]} * {wide[2]})")


def _ranked(phrases: DataFrame, most: int) -> DataFrame:
    """The best of each language with their ranks; first the best of each share of its phrases, so that no task ranks them all."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    share = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SHARES))).orderBy(*order)
    some = phrases.withColumn("rank", F.row_number().over(share)).where(F.col("rank") <= most)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= most)


def collocations(docs: DataFrame, top: int = 2000, least: int = 10, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best ``top`` phrases of each language.

    A-Z count as a-z; sentence marks and line ends cut texts into pieces, spaces and tabs
    pieces into words; phrases lie within a piece.  A phrase occurs ``least`` times or more.
    Two words are dropped if a phrase of three has them in at least half of their occurrences.
    Ties go to the phrase that occurs more often, then to the smaller one by its bytes.  A null
    language is ``und``, a null text has no words; rows that repeat count each time; very long
    texts are counted whole; an empty table gives no rows.
    """
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    singles = store(_count(texts, 1, _Words.singles))
    total = singles.groupBy("lang").agg(F.sum("n").alias("n"))
    growing = singles.where(F.col("n") >= least)
    held = bits(growing, ["w1"])
    pairs = _count(texts, 2, lambda words: words.pairs(held)).where(F.col("n") >= least)
    left, right = growing.select("lang", "w1", F.col("n").alias("l")), growing.select("lang", F.col("w1").alias("w2"), F.col("n").alias("r"))
    pairs = pairs.withColumnRenamed("n", "a").join(left, ["lang", "w1"]).join(right, ["lang", "w2"])
    pairs = pairs.withColumn("score", _score("a", "l", "r")).withColumn("bound", F.expr(f"cast({SCALE} as decimal(38,0)) * a div l"))
    pairs = store(pairs.select("lang", "w1", "w2", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", "score", "bound"))
    often = bits(pairs, ["w1", "w2"])

    rank, done, open_langs = int(top * SLACK), None, total.select("lang")
    while True:
        own = pairs.join(open_langs, "lang", "left_semi")
        if rank <= LAST_RANK:
            seen = _ranked(own, rank).groupBy("lang").agg(F.min("score").alias("low"), F.count("*").alias("seen"))
            least_score = store(seen.select("lang", F.when(F.col("seen") < rank, 0).otherwise(F.col("low")).alias("threshold")))
        else:
            least_score = store(open_langs.select("lang", F.lit(0).cast("long").alias("threshold")))
        survivors = store(_survivors(texts, own, least_score, often, least))
        enough = survivors.groupBy("lang").agg(F.count("*").alias("found"))
        settled = least_score.join(enough, "lang", "left").where((F.col("threshold") == 0) | (F.col("found") >= top)).select("lang")
        settled = store(settled)
        best = _ranked(survivors.join(settled, "lang", "left_semi"), top)
        done = best if done is None else done.unionByName(best)
        open_langs = store(least_score.select("lang").join(settled, "lang", "left_anti"))
        if open_langs.isEmpty():
            break
        rank *= GROWTH
    return done.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _survivors(texts: DataFrame, pairs: DataFrame, thresholds: DataFrame, often: Bits, least: int) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of every phrase that scores its language's threshold or more and is not dropped.

    Hashes are of a language's own words, so texts of settled languages find nothing in the bitmaps.
    """
    pairs = pairs.join(thresholds, "lang")
    frontier = bits(pairs.where("bound >= threshold"), ["w1", "w2"])
    reaching = pairs.where("score >= threshold")
    contested = bits(reaching, ["w1", "w2"])
    triples = _count(texts, 3, lambda words: words.triples(often, frontier, contested)).where(F.col("n") >= least).withColumnRenamed("n", "a")
    head = pairs.select("lang", "w1", "w2", F.col("l").alias("f1"), F.col("a").alias("f12"))
    tail = pairs.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("f23"), F.col("r").alias("f3"))
    triples = triples.join(head, ["lang", "w1", "w2"]).join(tail, ["lang", "w2", "w3"])
    triples = store(triples.withColumn("s1", _score("a", "f1", "f23")).withColumn("s2", _score("a", "f12", "f3")))
    covering = [triples.where(f"2 * a >= {f}").select("lang", F.col(x).alias("w1"), F.col(y).alias("w2")) for f, x, y in (("f12", "w1", "w2"), ("f23", "w2", "w3"))]
    kept = reaching.join(covering[0].union(covering[1]).distinct(), ["lang", "w1", "w2"], "left_anti")
    first = F.col("s1") <= F.col("s2")
    longer = triples.select(
        "lang",
        F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"),
        "a",
        F.when(first, F.col("f1")).otherwise(F.col("f12")).alias("l"),
        F.when(first, F.col("f23")).otherwise(F.col("f3")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )
    longer = longer.join(thresholds, "lang").where("score >= threshold").drop("threshold")
    return kept.select("lang", "phrase", "a", "l", "r", "score").unionByName(longer)
