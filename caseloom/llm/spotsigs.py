"""SpotSigs fingerprints of documents, in DataFrame functions only.

A spot signature is a common word (the anchor) with the chain of content words that
follow it; common words between them are passed over.  A document's fingerprint is the set
of its signatures, and two fingerprints are as alike as the Jaccard index of their sets.
Pages keep their signatures when what surrounds their prose changes, since navigation and
lists have few common words.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.session import store

#: Common words of the languages at hand, lower case.
ANCHORS = (
    "a", "an", "the", "is", "was", "are", "were", "be", "been", "of", "to", "in", "and", "that", "for", "with", "on", "as", "at", "by", "this", "there", "said", "can", "do",
    "der", "die", "das", "und", "ist", "den", "dem", "des", "ein", "eine", "zu", "mit", "sich", "auf", "nicht",
    "le", "la", "les", "un", "une", "et", "est", "du", "que", "pour", "dans", "par",
    "el", "los", "las", "y", "del", "por", "con", "su", "se", "para",
)
CHAIN = 2
REACH = 8  # words looked at after an anchor for its chain
_MASK = (1 << 31) - 1


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.transform(F.array(value), body)[0]


def signatures(text: Column, anchors: tuple[str, ...] = ANCHORS, chain: int = CHAIN, reach: int = REACH) -> Column:
    """The sorted set of signatures of a text, as whole numbers of 31 bits.

    A text without any signature has one for the whole text, so that different texts stay
    apart; an empty or blank text has none; null counts as empty.
    """
    plain = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(F.lower(plain), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    # a word's hash, odd for anchors and even for content words
    codes = F.transform(words, lambda w: F.xxhash64(w).bitwiseAND(F.lit(-2)) + w.isin(*anchors).cast("long"))

    def odd(x: Column) -> Column:
        return x.bitwiseAND(F.lit(1)) == 1

    def spot(c: Column, x: Column, i: Column) -> Column:
        following = F.filter(F.slice(c, i + 2, F.lit(reach)), lambda y: ~odd(y))
        whole = lambda t: F.when(F.size(t) >= chain, F.xxhash64(x, *[F.get(t, F.lit(k)) for k in range(chain)]))
        return F.when(odd(x), _let(following, whole))

    found = _let(codes, lambda c: F.filter(F.transform(c, lambda x, i: spot(c, x, i)), lambda s: s.isNotNull()))
    short = F.transform(found, lambda s: s.bitwiseAND(F.lit(_MASK)).cast("int"))
    alone = F.when(F.trim(plain) != "", F.array(F.xxhash64(plain).bitwiseAND(F.lit(_MASK)).cast("int"))).otherwise(F.array().cast("array<int>"))
    return _let(short, lambda s: F.when(F.size(s) > 0, F.sort_array(F.array_distinct(s))).otherwise(alone))


def fingerprint(sigs: Column) -> Column:
    """The set written out: eight hex digits for each signature, ascending."""
    return F.array_join(F.transform(sigs, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard index of two sets of signatures; 1 for two empty ones."""
    shared = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - shared
    return F.when(union == 0, F.lit(1.0)).otherwise(shared / union)


def _same(pairs: list[tuple[str, str]]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(a).eqNullSafe(F.col(b)) for a, b in pairs])


def successors(keys: DataFrame) -> DataFrame:
    """``doc_id, tie, n_chars`` with the next row in ascending order as ``next_id, next_tie``; after the last, the first.

    Rows are ordered within ranges of the key, and the last of a range takes the first of
    the next range; only the ranges' first rows, as many as there are shuffle partitions,
    are ordered in one task.
    """
    spark = keys.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = store(keys.repartitionByRange(ranges, "doc_id", "tie").withColumn("range", F.spark_partition_id()))
    firsts = dealt.groupBy("range").agg(F.min(F.struct("doc_id", "tie")).alias("first"))
    one = Window.partitionBy(F.lit(0))
    after = F.lead("first").over(one.orderBy("range"))
    heads = firsts.select("range", F.coalesce(after, F.first("first").over(one.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow))).alias("head"))
    own = F.lead(F.struct("doc_id", "tie")).over(Window.partitionBy("range").orderBy("doc_id", "tie"))
    linked = dealt.withColumn("own", own).join(F.broadcast(heads), "range").withColumn("next", F.coalesce("own", "head"))
    return linked.select("doc_id", "tie", "n_chars", F.col("next.doc_id").alias("next_id"), F.col("next.tie").alias("next_tie"))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited form: the last half made of the next document's beginning.

    One row per row of ``docs``: ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``.  Null texts are empty.  The order is by id,
    a null id first, and by text among equal ids; rows equal in both count once in the order.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("tie"), "text")
    links = store(successors(rows.select("doc_id", "tie", F.length("text").alias("n_chars")).distinct()))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    # Every text goes to its predecessor: no more of it than that one takes.  Signatures are
    # made after the shuffle of the texts, which both joins read, rather than sent along.
    asked = links.select(F.col("doc_id").alias("p_id"), F.col("tie").alias("p_tie"), "n_chars", "next_id", "next_tie")
    sent = rows.join(asked, _same([("doc_id", "next_id"), ("tie", "next_tie")]))
    sent = sent.select("p_id", "p_tie", F.substring("text", F.lit(1), half).alias("head"), signatures(F.col("text")).alias("next_sigs"))
    sent = sent.dropDuplicates(["p_id", "p_tie"])
    met = rows.join(sent, _same([("doc_id", "p_id"), ("tie", "p_tie")])).withColumn("n_chars", F.length("text"))
    kept = F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int"))
    met = met.select("doc_id", "n_chars", "text", F.concat(kept, "head").alias("edited"), "next_sigs")
    # a generator between the two steps keeps texts and signatures from being made again for each use
    made = F.struct("edited", signatures(F.col("edited")).alias("sigs"), signatures(F.col("text")).alias("own"))
    met = met.withColumn("edit", F.explode(F.array(made)))
    return met.select(
        "doc_id",
        F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2(F.col("edit.edited"), 256).alias("edited_sha256"),
        fingerprint(F.col("edit.own")).alias("fingerprint"),
        fingerprint(F.col("edit.sigs")).alias("edited_fingerprint"),
        likeness(F.col("edit.own"), F.col("edit.sigs")).alias("near_edited"),
        likeness(F.col("edit.own"), F.col("next_sigs")).alias("near_next"),
    )


def similar_pairs(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``a, b, likeness``: pairs of documents ``a < b`` whose fingerprints are at least so alike.

    Documents of equal fingerprints form a class that its smallest id stands for, so pairs are
    between classes (:func:`classes` has the members).  Sets are dealt by length to ranges a
    factor of the threshold wide: only sets of the same or the next range can be alike enough.
    Within those, two sets must share one of the rarest signatures of each: as many as they may
    differ in, and one more.  Sets are compared for such candidates only.
    """
    sets = store(classes(docs, id_col, text_col).groupBy("sigs").agg(F.min("doc_id").alias("doc_id")).where("doc_id IS NOT NULL AND size(sigs) > 0"))
    n = F.size("sigs")
    ranged = sets.withColumn("range", F.floor(F.log(n) / F.lit(-1.0) / F.log(F.lit(threshold))).cast("int"))
    spread = ranged.select("doc_id", "range", n.alias("n"), F.explode("sigs").alias("sig"))
    rarity = spread.groupBy("sig").agg(F.count("*").alias("df"))
    ordered = spread.join(rarity, "sig").groupBy("doc_id", "range", "n").agg(F.sort_array(F.collect_list(F.struct("df", "sig"))).alias("by"))
    first = F.slice("by.sig", F.lit(1), (F.col("n") - F.ceil(F.col("n") * threshold) + 1).cast("int"))
    index = store(ordered.select("doc_id", "range", "n", F.explode(first).alias("sig")))
    probe = index.select(F.col("doc_id").alias("other"), F.col("n").alias("m"), "sig", F.explode(F.array("range", F.col("range") + 1)).alias("range"))
    found = index.join(probe, ["sig", "range"]).where("doc_id <> other AND least(n, m) >= greatest(n, m) * " + repr(threshold))
    pairs = found.select(F.least("doc_id", "other").alias("a"), F.greatest("doc_id", "other").alias("b")).distinct()
    with_a = pairs.join(sets.toDF("sa", "a"), "a")
    both = with_a.join(sets.toDF("sb", "b"), "b")
    return both.select("a", "b", likeness(F.col("sa"), F.col("sb")).alias("likeness")).where(F.col("likeness") >= threshold)


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, sigs`` of every document."""
    return docs.select(F.col(id_col).alias("doc_id"), signatures(F.col(text_col).cast("string")).alias("sigs"))
