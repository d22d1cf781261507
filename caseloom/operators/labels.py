"""Keyword labelling and label catalogues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom import config
from caseloom.functions import text as X
from caseloom.operators import skew, windows
from caseloom.session import store

PIECE = 1 << 16
DIGEST = ["_h0", "_h1"]


def label_messages(
    df: DataFrame,
    rules=config.INTENT_RULES,
    column: str = "customer_message",
    default: str = config.DEFAULT_INTENT,
    null_label: str | None = None,
) -> DataFrame:
    """Add ``intent``: the first rule, in order, with a keyword inside the lower-cased message.

    The lower-cased message is a column of its own, so that it is made once and the rules
    are compiled conditions on it.
    """
    low = df.withColumn("_low", F.lower(F.col(column)))
    return low.withColumn("intent", X.first_label_of(F.col("_low"), rules, default, null_label)).drop("_low")


def rule_matches(df: DataFrame, rules: DataFrame, column: str) -> DataFrame:
    """Rules ``(priority, label, keyword)`` with their keyword inside a message, beside the 128-bit digest of the message.

    A keyword of n characters is inside a text if it is one of the text's substrings of n
    characters.  Tasks hash the substrings of the lengths that keywords have, and those that a
    bitmap of the keywords' hashes lets through are joined with the keywords by equality.  The
    hashing grows with the texts and the number of different lengths, the join with the
    keywords found.  The rules are written first, so their real size decides whether they are
    sent to the substrings.  A NULL text or keyword matches nothing, an empty keyword matches
    every text; a text that is there twice, or that is cut into pieces, may match twice.
    """
    words = store(rules.where(F.col("keyword").isNotNull()).select("priority", "keyword", "label"))
    texts = df.select(F.lower(F.col(column)).alias("_low")).withColumns(_digest("_low"))
    return windows.find(texts, "_low", DIGEST, words, "keyword", PIECE).join(words, "keyword")


def _digest(text: str) -> dict[str, Column]:
    return {name: F.xxhash64(F.lit(i), F.col(text)) for i, name in enumerate(DIGEST)}


def label_by_table(
    df: DataFrame, rules: DataFrame, column: str = "customer_message", default: str = config.DEFAULT_INTENT
) -> DataFrame:
    """Add ``intent`` by rules from a table, however many: that of the first rule, by priority and keyword, inside the message.

    ``df`` is read twice: for its texts, and to get its labels.
    """
    first = rule_matches(df, rules, column).groupBy(*DIGEST).agg(F.min(F.struct("priority", "keyword", "label")).alias("_rule"))
    told = df.withColumn("_low", F.lower(F.col(column))).withColumns(_digest("_low")).join(first, DIGEST, "left")
    return told.select(*df.columns, F.coalesce("_rule.label", F.lit(default)).alias("intent"))


def keyword_hits_by_table(df: DataFrame, rules: DataFrame, column: str = "customer_message") -> DataFrame:
    """One row per message and different ``(intent, keyword)`` of a table of rules whose keyword is inside the message."""
    hits = rule_matches(df, rules, column).select(*DIGEST, F.col("label").alias("intent"), "keyword").distinct()
    keyed = df.withColumn("_low", F.lower(F.col(column))).withColumns(_digest("_low")).drop("_low")
    return keyed.join(hits, DIGEST).select(*df.columns, "intent", "keyword")


def keyword_hits(df: DataFrame, rules, column: str = "customer_message") -> DataFrame:
    """One row per message and matching keyword, with the label of its rule."""
    low = F.lower(F.col(column))
    pairs = [
        F.when(F.contains(low, F.lit(k)), F.struct(F.lit(label).alias("intent"), F.lit(k).alias("keyword")))
        for label, words in rules
        for k in words
    ]
    hits = F.array_compact(F.array(*pairs))
    return df.withColumn("_hit", F.explode(hits)).select(*df.columns, "_hit.intent", "_hit.keyword")


def label_distribution(labelled: DataFrame) -> DataFrame:
    from caseloom.operators.profile import distribution

    return distribution(labelled, "intent")


def examples_per_label(labelled: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` cases of every label in case order."""
    top = skew.top_n_per_group(labelled, ["intent"], [F.col("customer_tweet_id"), F.col("brand_tweet_id")], n)
    return top.select(
        F.concat(F.lit("EX_"), "case_id").alias("example_id"),
        "customer_message",
        "intent",
        "conversation_id",
        "brand_reply",
    )


def label_catalogue(labelled: DataFrame) -> DataFrame:
    """Definition row for every observed label."""
    return labelled.select("intent").distinct().select(
        "intent",
        F.concat(F.lit(config.CATALOGUE_DESCRIPTION), F.replace("intent", F.lit("_"), F.lit(" "))).alias("description"),
        F.lit(config.CATALOGUE_INCLUDE).alias("include_examples"),
        F.lit(config.CATALOGUE_EXCLUDE).alias("exclude_examples"),
        F.lit(config.CATALOGUE_ACTION).alias("expected_action"),
        F.lit(config.CATALOGUE_RISK).alias("escalation_risk"),
    )


def label_set_difference(left: DataFrame, right: DataFrame, column: str = "intent") -> DataFrame:
    """Labels found on one side only."""
    a, b = left.select(column).distinct(), right.select(column).distinct()
    only_left = a.exceptAll(b).withColumn("side", F.lit("left_only"))
    return only_left.unionByName(b.exceptAll(a).withColumn("side", F.lit("right_only")))
