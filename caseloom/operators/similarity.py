"""TF-IDF features and exact top-k retrieval of similar cases."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom import config, schemas
from caseloom.functions import text as X
from caseloom.operators import products, skew
from caseloom.session import store

EPS = 1e-8

# A query first reads its most telling blocks of postings, as many as have so many postings
# in total.  What that does not settle goes on with GROWTH times as many.
FIRST_BUDGET = 1_000
GROWTH = 20
# Pairs of a query and a posting are rows only as far as all queries may read so many in a round,
# each of them again with every term of its query that has skipped blocks.
MOST_PAIRS = 5_000_000
# A term of more documents than WHOLE has a block for each STEPS-th part of a halving of the weight.
WHOLE = 32
STEPS = 4


@lru_cache(maxsize=8)
def default_stop_words(language: str = "english") -> tuple:
    """Stop words that ship with Spark ML."""
    from pyspark.ml.feature import StopWordsRemover

    return tuple(StopWordsRemover.loadDefaultStopWords(language))


# --- grouping of cases ------------------------------------------------------


def case_key(cases: DataFrame) -> str:
    return "customer_tweet_id" if "customer_tweet_id" in cases.columns else "case_id"


def fill_cases(cases: DataFrame) -> DataFrame:
    """Text columns as strings, with '' for a missing text and the default intent for a missing label."""
    filled = cases.withColumn("intent", F.coalesce(F.col("intent").cast("string"), F.lit(config.DEFAULT_INTENT)))
    for c in ("customer_message", "brand_reply"):
        filled = filled.withColumn(c, F.coalesce(F.col(c).cast("string"), F.lit("")))
    for c in ("case_id", "conversation_id"):
        filled = filled.withColumn(c, F.col(c).cast("string"))
    return filled


def group_cases(cases: DataFrame, order: str = "brand_tweet_id") -> DataFrame:
    """One row per customer message: the fields of its first case, its first reply and the number of replies.

    All replies are in :func:`replies_of`, so the size of a row does not depend on how often
    a message was answered.
    """
    return unpacked(first_cases(cases, order))


def first_cases(cases: DataFrame, order: str = "brand_tweet_id") -> DataFrame:
    """``doc_id, first, n_replies``: ``first`` has the order and the fields of a message's first case.

    ``cases`` is read once: the smallest row and the count of a message come from one aggregate,
    which needs no shuffle where a join has brought the message's cases together.
    """
    key = case_key(cases)
    order = order if order in cases.columns else "case_id"
    fields = [c for c in ("customer_message", "case_id", "conversation_id", "intent", "customer_user", "brand_reply") if c in cases.columns]
    rows = cases.where(F.col(key).isNotNull()).select(F.col(key).alias("doc_id"), F.struct(F.col(order).alias("_o"), *fields).alias("first"))
    return rows.groupBy("doc_id").agg(F.min("first").alias("first"), F.count(F.lit(1)).alias("n_replies"))


def unpacked(firsts: DataFrame) -> DataFrame:
    return firsts.select("doc_id", "first.*", "n_replies").drop("_o")


def replies_of(cases: DataFrame, order: str = "brand_tweet_id") -> DataFrame:
    """Every reply as a row ``(doc_id, reply_order, brand_reply)``, however many a message has."""
    key = case_key(cases)
    order = order if order in cases.columns else "case_id"
    return cases.where(F.col(key).isNotNull()).select(
        F.col(key).alias("doc_id"), F.col(order).alias("reply_order"), F.coalesce("brand_reply", F.lit("")).alias("brand_reply")
    )


# --- TF-IDF -----------------------------------------------------------------


def term_counts(docs: DataFrame, doc_id: str, text: str, stop_words=()) -> DataFrame:
    """``(doc_id, term, tf)``.  The texts are dealt out by id first, which is fewer bytes than their counts,
    so that neither the counts nor what is made of a document's weights later is shuffled again."""
    dealt = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text")).repartition("doc_id")
    words = dealt.select("doc_id", F.explode(X.tokens("_text")).alias("term"))
    # Joins on the term filter out NULL; with the filter already here the counts of one
    # table have one plan, and Spark computes them once.
    words = words.where(F.col("term").isNotNull())
    if stop_words:
        words = words.where(~F.col("term").isin(list(stop_words)))
    return words.groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf"))


def vocabulary(counts: DataFrame, n_docs: Column, max_features: int = config.DEFAULT.max_features) -> DataFrame:
    """The ``max_features`` most frequent terms with smoothed inverse document frequency."""
    terms = counts.groupBy("term").agg(F.sum("tf").alias("frequency"), F.count(F.lit(1)).alias("df"))
    return most_frequent(terms, n_docs, max_features)


def most_frequent(terms: DataFrame, n_docs: Column, max_features: int = config.DEFAULT.max_features) -> DataFrame:
    """The same from ``(term, frequency, df)``."""
    top = terms.orderBy(F.desc("frequency"), "term").limit(max_features)
    return top.withColumn("idf", F.log((n_docs + 1.0) / (F.col("df") + 1.0)) + 1.0)


def n_rows(df: DataFrame) -> Column:
    return df.agg(F.count(F.lit(1)).alias("n")).scalar()


def tfidf(counts: DataFrame, vocab: DataFrame) -> DataFrame:
    """L2-normalised weights ``(doc_id, term, weight)``."""
    raw = counts.join(vocab.select("term", "idf"), "term").withColumn("raw", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy("doc_id")))
    return raw.select("doc_id", "term", (F.col("raw") / norm).alias("weight"))


def vectors(counts: DataFrame, vocab: DataFrame) -> DataFrame:
    """One sparse unit vector per document, sorted by term, with a digest that equal vectors share.

    An entry has the term's document frequency beside its weight.
    """
    raw = counts.join(vocab.select("term", "idf", "df"), "term")
    entry = F.struct("term", (F.col("tf") * F.col("idf")).alias("weight"), "df")
    rows = raw.groupBy("doc_id").agg(F.array_sort(F.collect_list(entry)).alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda acc, e: acc + e["weight"] * e["weight"]))
    unit = rows.withColumn("norm", norm).withColumn(
        "v", F.transform("v", lambda e: F.struct(e["term"].alias("term"), (e["weight"] / F.col("norm")).alias("weight"), e["df"].alias("df")))
    )
    return unit.select("doc_id", F.unhex(F.sha2(F.to_json("v"), 256)).alias("vec_key"), "v")


# --- index ------------------------------------------------------------------


@dataclass(frozen=True)
class CaseIndex:
    """Tables of a retrieval index."""

    cases: DataFrame  # doc_id and the fields shown in results
    replies: DataFrame  # doc_id, reply_order, brand_reply: all replies
    vocab: DataFrame  # term, frequency, df, idf
    members: DataFrame  # doc_id, vec_id
    postings: DataFrame  # vec_id, term, weight, df, level: one entry per distinct vector
    blocks: DataFrame  # term, level, top, n: the largest weight and the length of each block of postings
    stop_words: tuple = ()
    pages: int = 0  # of a stored index: cases, members and postings lie in so many pages, by a hash of PAGED

    PAGED = {"cases": "doc_id", "members": "vec_id", "postings": "term"}
    TABLES = ("cases", "replies", "vocab", "members", "postings", "blocks")


def page_of(key: str, pages: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(pages)).cast("int")


def in_pages(index: CaseIndex, table: str, wanted: DataFrame) -> DataFrame:
    """A table as far as it can hold a wanted key.

    Of a stored index only the pages of those keys are read, which few messages need few of;
    the page numbers, at most ``index.pages``, come to the driver.  ``wanted`` should be cheap.
    """
    if not index.pages:
        return getattr(index, table)
    pages = wanted.select(page_of(index.PAGED[table], index.pages).alias("page")).distinct().collect()
    return getattr(index, table).where(F.col("page").isin([r["page"] for r in pages])).drop("page")


def build_index(
    cases: DataFrame,
    stop_words=None,
    max_features: int = config.DEFAULT.max_features,
    order: str = "brand_tweet_id",
    keep: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> CaseIndex:
    """Group the cases, fit the vocabulary and lay out the postings.

    With ``keep=store`` every table is written once and the next one is built from it;
    without it the tables are lazy.
    """
    stop_words = default_stop_words() if stop_words is None else tuple(stop_words)
    filled = fill_cases(cases)
    replies = keep(replies_of(filled, order))
    grouped = keep(group_cases(filled, order))
    counts = keep(term_counts(grouped, "doc_id", "customer_message", stop_words))
    vocab = keep(vocabulary(counts, n_rows(grouped), max_features))
    return lay_out(grouped, replies, counts, vocab, stop_words, keep)


def lay_out(grouped: DataFrame, replies: DataFrame, counts: DataFrame, vocab: DataFrame, stop_words: tuple, keep) -> CaseIndex:
    """The index of cases whose terms are counted: equal vectors once, their postings in blocks."""
    vecs = keep(vectors(counts, vocab))
    distinct = keep(vecs.groupBy("vec_key").agg(F.min("doc_id").alias("vec_id"), F.any_value("v").alias("v")))
    members = keep(vecs.select("doc_id", "vec_key").join(distinct.select("vec_key", "vec_id"), "vec_key").select("doc_id", "vec_id"))
    postings = keep(with_levels(distinct.select("vec_id", F.inline("v"))))
    return CaseIndex(grouped, replies, vocab, members, postings, keep(block_maxima(postings)), stop_words)


def with_levels(postings: DataFrame) -> DataFrame:
    """Postings with the ``level`` that places them in a block of their term.

    Level 1 has the largest weights of a term, so blocks are in the order of impact; which
    one a posting is in follows from its weight alone, so none of them is ever sorted.
    """
    level = F.least(F.lit(64), 1 + F.floor(-F.log2("weight") * STEPS)).cast("int")
    return postings.withColumn("level", F.when(F.col("df") <= WHOLE, 0).otherwise(level))


def block_maxima(postings: DataFrame) -> DataFrame:
    """What a block can add to a score at most, and what it costs to read."""
    return postings.groupBy("term", "level").agg(F.max("weight").alias("top"), F.count(F.lit(1)).alias("n"))


# --- retrieval --------------------------------------------------------------


def retrieve(
    queries: DataFrame,
    index: CaseIndex,
    top_k: int = config.DEFAULT.top_k,
    min_similarity: float = config.DEFAULT.min_similarity,
    query_id: str = "message_id",
    text: str = "message",
    budget: int = FIRST_BUDGET,
    keep: Callable[[DataFrame], DataFrame] = store,
) -> DataFrame:
    """Queries with ``retrieval``: struct of sufficient, top_cases, top_similarity and n_results.

    Equal query vectors are searched once and equal document vectors are stored once.
    Queries without a known term get an empty result.  ``keep`` writes what is read again.
    """
    counts = term_counts(queries, query_id, text, index.stop_words)
    q_vecs = keep(vectors(counts, index.vocab).withColumnRenamed("doc_id", query_id))
    distinct = keep(q_vecs.groupBy("vec_key").agg(F.min(query_id).alias("q_key"), F.any_value("v").alias("v")))
    q_terms = distinct.select("q_key", F.inline("v")).withColumnRenamed("weight", "q_weight")
    hits = search(q_terms, index, top_k, budget, keep)
    # keys meet before the answers, which are long, are joined
    same = q_vecs.select(query_id, "vec_key").join(distinct.select("vec_key", "q_key"), "vec_key").drop("vec_key")
    keyed = same.join(_answers(hits, index, top_k, min_similarity), "q_key").drop("q_key")
    out = queries.join(keyed, query_id, "left")
    return out.withColumn("retrieval", F.coalesce("retrieval", no_result())).select(*queries.columns, "retrieval")


def evidence_replies(answered: DataFrame, index: CaseIndex, query_id: str = "message_id") -> DataFrame:
    """Every reply of every retrieved case as a row, however many there are."""
    shown = answered.select(query_id, F.explode("retrieval.top_cases").alias("c"))
    shown = shown.select(query_id, "c.case_id", F.col("c.customer_tweet_id").alias("_doc"))
    replies = index.replies.withColumn("_doc", F.col("doc_id").cast("string"))
    return shown.join(replies, "_doc").select(query_id, "case_id", "reply_order", "brand_reply")


def no_result() -> Column:
    return F.struct(
        F.lit(False).alias("sufficient"),
        F.array().cast(schemas.TOP_CASES).alias("top_cases"),
        F.lit(0.0).alias("top_similarity"),
        F.lit(0).alias("n_results"),
    )


def _answers(hits: DataFrame, index: CaseIndex, top_k: int, min_similarity: float) -> DataFrame:
    # Copies of a vector tie, so at most top_k members of it, the smallest ids, can be in a result.
    found = in_pages(index, "members", hits).join(hits.select("vec_id").distinct(), "vec_id", "left_semi")
    few = skew.top_n_per_group(found, ["vec_id"], [F.col("doc_id")], top_k)
    docs = hits.join(few, "vec_id")
    ranked = skew.top_n_per_group(docs, ["q_key"], [F.desc("rank_score"), F.col("doc_id")], top_k, rank="place")
    named = in_pages(index, "cases", ranked).join(ranked.select("doc_id").distinct(), "doc_id", "left_semi")
    shown = ranked.join(named, "doc_id")
    case = F.struct(
        "place",
        F.struct(
            "case_id",
            F.col("doc_id").cast("string").alias("customer_tweet_id"),
            "customer_message",
            "brand_reply",
            "n_replies",
            "intent",
            F.round("score", 4).alias("similarity_score"),
            "conversation_id",
        ).alias("case"),
    )
    per_query = shown.groupBy("q_key").agg(
        F.array_sort(F.collect_list(case)).alias("c"), F.max("score").alias("top"), F.count(F.lit(1)).cast("int").alias("n")
    )
    return per_query.select(
        "q_key",
        F.struct(
            (F.col("top") >= min_similarity).alias("sufficient"),
            F.col("c.case").cast(schemas.TOP_CASES).alias("top_cases"),
            F.round("top", 4).alias("top_similarity"),
            F.col("n").alias("n_results"),
        ).alias("retrieval"),
    )


def search(
    q_terms: DataFrame,
    index: CaseIndex,
    top_k: int,
    budget: int = FIRST_BUDGET,
    keep: Callable[[DataFrame], DataFrame] = store,
) -> DataFrame:
    """Exact top ``top_k`` vectors per query ``(q_key, term, q_weight)``: ``(q_key, vec_id, score, rank_score)``.

    A query reads whole blocks, those of largest impact first.  What the blocks that it skips
    can add at most tells which queries are settled; the others go on with a larger budget,
    until none is open.  A budget that takes in all blocks of a query always settles it.

    Rounds are for queries that make at most ``MOST_PAIRS`` rows in a round, as their reading plan
    tells before any is made.  All others are answered by products of blocks, whose scores never
    leave their task.
    """
    open_terms, done = q_terms, []
    n_open = q_terms.select("q_key").distinct().count()
    while n_open * budget <= MOST_PAIRS:
        plan = keep(_reading_plan(open_terms, index.blocks, budget))
        if (plan.agg(F.sum("rows")).first()[0] or 0) > MOST_PAIRS:
            break
        postings = in_pages(index, "postings", plan.select(F.explode("terms.term").alias("term")))
        found = keep(_search_blocks(plan, postings, top_k))
        done.append(found.where("settled").select("q_key", F.inline("top")))
        unsettled = found.where("NOT settled").select("q_key")
        n_open = unsettled.count()
        if not n_open:
            break
        open_terms = plan.select("q_key", F.inline("terms")).select("q_key", "term", "q_weight").join(unsettled, "q_key", "left_semi")
        budget *= GROWTH
    if n_open:
        postings = in_pages(index, "postings", open_terms.select("term"))
        best = products.best_of_blocks(open_terms, postings, top_k)
        done.append(keep(skew.top_n_per_group(best, ["q_key"], [F.desc("rank_score"), F.col("vec_id")], top_k)))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def _top(scores: DataFrame, top_k: int) -> DataFrame:
    # Rounded for ranking, so that the order of float additions cannot decide a tie.
    ranked = scores.where("score > 0").withColumn("rank_score", F.round("score", 9))
    return skew.top_n_per_group(ranked, ["q_key"], [F.desc("rank_score"), F.col("vec_id")], top_k)


def _reading_plan(q_terms: DataFrame, blocks: DataFrame, budget: int) -> DataFrame:
    """One row per query: ``q_key``, its ``terms``, the bounds ``sums`` and ``length`` of what is skipped, and ``rows``.

    A term has the ``levels`` to read and ``more``, the most that its other blocks can add.
    Blocks are read from the largest impact on, while they have at most ``budget`` postings in
    total; the first is always read.  A vector without any posting read scores at most
    ``sums``, and as vectors have length 1, at most ``length``.  ``rows`` is the most that the
    search can make: a pair for every posting read, and that pair with every term of skipped blocks.
    """
    impact = F.col("q_weight") * F.col("top")
    order = Window.partitionBy("q_key").orderBy(F.desc("impact"), "term", "level")
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    chosen = q_terms.select("q_key", "term", "q_weight").join(blocks, "term").withColumn("impact", impact)
    chosen = chosen.withColumn("read", (before == 0) | (before + F.col("n") <= budget))
    terms = chosen.groupBy("q_key", "term").agg(
        F.max("q_weight").alias("q_weight"),
        F.coalesce(F.max(F.when(~F.col("read"), F.col("impact"))), F.lit(0.0)).alias("more"),
        F.collect_list(F.when(F.col("read"), F.col("level"))).alias("levels"),
        F.sum(F.when(F.col("read"), F.col("n")).otherwise(0)).alias("met"),
    )
    skipped = F.when(F.col("more") > 0, F.col("q_weight") * F.col("q_weight")).otherwise(0.0)
    return terms.groupBy("q_key").agg(
        F.collect_list(F.struct("term", "q_weight", "more", "levels")).alias("terms"),
        F.sum("more").alias("sums"),
        F.sqrt(F.sum(skipped)).alias("length"),
        (F.sum("met") * (1 + F.count_if(F.col("more") > 0))).alias("rows"),
    )


def _search_blocks(plan: DataFrame, postings: DataFrame, top_k: int) -> DataFrame:
    """Best vectors per query among those in a block it reads, and whether they are ``settled``.

    Of a vector that was met, only terms it was not met by can add more, each at most its
    ``more`` and all together at most what its own length leaves.  Vectors that can still
    reach the ``top_k``-th get their other postings; the result is final when its last score
    is above all that an unmet vector can have.  Every query has a row, if only an empty one.
    """
    terms = plan.select("q_key", "sums", "length", F.inline("terms"))
    reads = terms.select("q_key", "sums", "length", "term", "q_weight", "more", F.explode("levels").alias("level"))
    met = reads.join(postings.drop("df"), ["term", "level"]).groupBy("q_key", "vec_id").agg(
        F.sum(F.col("q_weight") * F.col("weight")).alias("part"),
        F.sum(F.col("weight") * F.col("weight")).alias("seen"),
        F.sum("more").alias("met_more"),
        F.max("sums").alias("sums"),
        F.max("length").alias("length"),
    )
    whole = Window.partitionBy("q_key")
    nth = F.row_number().over(whole.orderBy(F.desc("part"), "vec_id"))
    kth = F.coalesce(F.max(F.when(F.col("nth") == top_k, F.col("part"))).over(whole), F.lit(0.0))
    by_length = F.col("length") * F.sqrt(F.greatest(F.lit(0.0), 1 - F.col("seen")))
    best = F.col("part") + F.greatest(F.lit(0.0), F.least(F.col("sums") - F.col("met_more"), by_length))
    able = met.withColumn("nth", nth).withColumn("kth", kth).where(best >= F.col("kth") - EPS)

    pairs = able.where("sums > 0").select("q_key", "vec_id")
    others = terms.where("more > 0").select("q_key", "term", "q_weight", "levels")
    extra = pairs.join(others, "q_key").join(postings, ["vec_id", "term"])
    extra = extra.where(~F.array_contains("levels", F.col("level"))).select("q_key", "vec_id", (F.col("q_weight") * F.col("weight")).alias("part"))
    scores = able.select("q_key", "vec_id", "part").unionByName(extra).groupBy("q_key", "vec_id").agg(F.sum("part").alias("score"))
    top = _top(scores, top_k).groupBy("q_key").agg(
        F.collect_list(F.struct("vec_id", "score", "rank_score")).alias("top"),
        F.min("rank_score").alias("last"),
        F.count(F.lit(1)).alias("n"),
    )
    every = plan.select("q_key", F.least("sums", "length").alias("unmet")).join(top, "q_key", "left")
    full = (F.col("n") == top_k) & (F.col("last") > F.col("unmet") + EPS)
    settled = (F.col("unmet") == 0) | F.coalesce(full, F.lit(False))
    none = F.array().cast(top.schema["top"].dataType)
    return every.select("q_key", settled.alias("settled"), F.coalesce("top", none).alias("top"))
