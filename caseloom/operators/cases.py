"""From message tables to support cases: directions, pairing, latency, validity, clean text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.functions import text as X
from caseloom.operators import skew
from caseloom.session import store

CASE_KEY = ["customer_tweet_id", "brand_tweet_id"]


def is_inbound(tweets: DataFrame) -> Column:
    """The direction flag as a boolean; a text other than true or false gives NULL.

    A boolean column is used as it is, so that the filter reaches the scan.
    """
    flag = F.col("inbound")
    if isinstance(tweets.schema["inbound"].dataType, T.BooleanType):
        return flag
    low = F.lower(flag.cast("string"))
    return F.when(low == "true", F.lit(True)).when(low == "false", F.lit(False))


def customer_messages(tweets: DataFrame) -> DataFrame:
    return tweets.where(is_inbound(tweets))


def brand_messages(tweets: DataFrame) -> DataFrame:
    return tweets.where(~is_inbound(tweets))


def by_author(tweets: DataFrame, author: str) -> DataFrame:
    return tweets.where(F.col("author_id") == F.lit(author))


def pair_messages(tweets: DataFrame, replies: DataFrame | None = None) -> DataFrame:
    """Customer message with each brand reply to it (one to many); ``replies`` if they lie in a table of their own."""
    customers = customer_messages(tweets).select(
        F.col("tweet_id").alias("customer_tweet_id"),
        F.col("author_id").alias("customer_user"),
        F.col("text").alias("customer_message"),
        F.col("created_at").alias("customer_created_at"),
    )
    brands = brand_messages(tweets if replies is None else replies).where(F.col("in_response_to_tweet_id").isNotNull()).select(
        F.col("in_response_to_tweet_id").alias("customer_tweet_id"),
        F.col("tweet_id").alias("brand_tweet_id"),
        F.col("author_id").alias("brand_account"),
        F.col("text").alias("brand_reply"),
        F.col("created_at").alias("brand_created_at"),
    )
    return brands.join(customers, "customer_tweet_id")


def add_latency(pairs: DataFrame) -> DataFrame:
    """Parse both creation times and add the signed ``reply_time_minutes``."""
    return (
        pairs.withColumn("customer_timestamp", X.parse_when("customer_created_at"))
        .withColumn("brand_timestamp", X.parse_when("brand_created_at"))
        .withColumn("reply_time_minutes", X.minutes_between("brand_timestamp", "customer_timestamp"))
    )


def with_case_ids(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("conversation_id", F.col("customer_tweet_id").cast("string")).withColumn(
        "case_id", F.concat(F.lit("CASE_"), F.col("customer_tweet_id").cast("string"))
    )


def to_cases(pairs: DataFrame) -> DataFrame:
    """Select and name the columns of the case table."""
    return with_case_ids(pairs).select(
        "customer_tweet_id",
        "brand_tweet_id",
        "customer_user",
        "brand_account",
        "customer_message",
        "brand_reply",
        "customer_timestamp",
        "brand_timestamp",
        "reply_time_minutes",
        "conversation_id",
        "case_id",
    )


def build_cases(tweets: DataFrame) -> DataFrame:
    return to_cases(add_latency(pair_messages(tweets)))


def flag_missing(cases: DataFrame) -> DataFrame:
    return cases.withColumn("missing_customer", X.is_blank("customer_message")).withColumn(
        "missing_reply", X.is_blank("brand_reply")
    )


def valid_cases(cases: DataFrame) -> DataFrame:
    """First row of every case key, unless its message or reply is blank."""
    first = skew.first_per_key(cases, CASE_KEY)
    return first.where(~X.is_blank("customer_message") & ~X.is_blank("brand_reply"))


def partition_cases(cases: DataFrame) -> DataFrame:
    """Every case row with its three defect flags and ``is_valid``."""
    marked = flag_missing(skew.mark_duplicates(cases, CASE_KEY))
    return marked.withColumn("is_valid", ~(F.col("missing_customer") | F.col("missing_reply") | F.col("is_duplicate")))


def case_quality(cases: DataFrame) -> DataFrame:
    """One-row validity report from counts per key.

    Where all rows of a key are sound, or none is, the counts tell whether its first row is.
    Only the rows of the keys that have both are ranked.
    """
    no_message, no_reply = X.is_blank("customer_message"), X.is_blank("brand_reply")
    per_key = cases.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(CASE_KEY)]).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(no_message).alias("no_message"),
        F.count_if(no_reply).alias("no_reply"),
        F.count_if(~no_message & ~no_reply).alias("sound"),
    )
    mixed = store(per_key.where("0 < sound AND sound < n").select("_k0", "_k1"))
    on = skew.same([(F.col(k), F.col(f"_k{i}")) for i, k in enumerate(CASE_KEY)])
    firsts = skew.first_per_key(cases.join(mixed, on, "left_semi"), CASE_KEY)
    none = F.lit(0).cast("long")
    told = per_key.select("n", "no_message", "no_reply", (F.col("sound") == F.col("n")).cast("long").alias("valid"), (F.col("n") - 1).alias("again"))
    ranked = firsts.select(*[none.alias(c) for c in ("n", "no_message", "no_reply")], (~no_message & ~no_reply).cast("long").alias("valid"), none.alias("again"))
    total = {c: F.coalesce(F.sum(c), none) for c in told.columns}
    return told.unionByName(ranked).agg(
        total["n"].alias("total_candidate_pairs"),
        total["valid"].alias("valid_pairs"),
        (total["n"] - total["valid"]).alias("removed_pairs"),
        total["no_message"].alias("missing_customer_messages"),
        total["no_reply"].alias("missing_brand_replies"),
        total["again"].alias("duplicates"),
        none.alias("other_invalid_cases"),
    )


def clean_text(df: DataFrame, column: str = "text") -> DataFrame:
    """Keep the text as ``original_text``, add ``clean_text``, and drop duplicate rows."""
    if column in df.columns:
        df = df.withColumn("original_text", F.col(column)).withColumn("clean_text", X.collapse_whitespace(column))
    return df.distinct()
