"""Brand volume, brand selection and the subset of messages around one brand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.operators import skew
from caseloom.operators.cases import brand_messages, customer_messages, pair_messages


def replies_per_brand(tweets: DataFrame) -> DataFrame:
    authors = brand_messages(tweets).where(F.col("author_id").isNotNull())
    return authors.groupBy(F.col("author_id").alias("brand")).agg(F.count(F.lit(1)).alias("replies"))


def brand_profile(replies: DataFrame) -> DataFrame:
    """Four volume columns per brand, counting one customer message for each reply."""
    return replies.select(
        "brand",
        (F.col("replies") * 2).alias("tweets"),
        F.col("replies").alias("customer_tweets"),
        F.col("replies").alias("brand_replies"),
        F.col("replies").alias("conversations"),
    )


def top_brands(replies: DataFrame, n: int) -> DataFrame:
    return replies.orderBy(F.desc("replies"), "brand").limit(n)


def exact_involvement(tweets: DataFrame) -> DataFrame:
    """What the profile approximates: answered messages, customers and replies from the pairs."""
    return pair_messages(tweets).groupBy(F.col("brand_account").alias("brand")).agg(
        F.count(F.lit(1)).alias("pairs"),
        F.countDistinct("customer_tweet_id").alias("customer_tweets"),
        F.countDistinct("customer_user").alias("customers"),
    )


def distinct_entities(tweets: DataFrame, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.countDistinct
    brands = brand_messages(tweets).agg(count("author_id").alias("n")).withColumn("entity", F.lit("brands"))
    customers = customer_messages(tweets).agg(count("author_id").alias("n")).withColumn("entity", F.lit("customers"))
    return brands.unionByName(customers)


def select_brand(replies: DataFrame, low: int, high: int, fallback_rank: int = 6) -> DataFrame:
    """Most active brand with ``low..high`` replies, else the one at ``fallback_rank``; no row if there is neither."""
    fitting = top_brands(replies.where(F.col("replies").between(low, high)), 1).withColumn("_choice", F.lit(0))
    fallback = replies.orderBy(F.desc("replies"), "brand").offset(fallback_rank - 1).limit(1).withColumn("_choice", F.lit(1))
    return brand_profile(fitting.unionByName(fallback).orderBy("_choice").limit(1))


def replies_to_brand(tweets: DataFrame, brand: str, replies: DataFrame | None = None) -> DataFrame:
    """Messages that answer a message of the brand; ``replies`` if they lie in a table of their own."""
    ids = tweets.where(F.col("author_id") == brand).select(F.col("tweet_id").alias("in_response_to_tweet_id")).distinct()
    linked = (tweets if replies is None else replies).where(F.col("in_response_to_tweet_id").isNotNull())
    return linked.join(ids, "in_response_to_tweet_id", "left_semi").select(*tweets.columns)


def answered_by_brand(tweets: DataFrame, brand: str, replies: DataFrame | None = None) -> DataFrame:
    """Messages that the brand answered; ``replies`` if they lie in a table of their own."""
    ids = (tweets if replies is None else replies).where((F.col("author_id") == brand) & F.col("in_response_to_tweet_id").isNotNull())
    ids = ids.select(F.col("in_response_to_tweet_id").alias("tweet_id")).distinct()
    return tweets.join(ids, "tweet_id", "left_semi")


def brand_subset(tweets: DataFrame, brand: str) -> DataFrame:
    """The brand's messages, replies to them and messages it answered, once per id.

    The brand's own messages are reduced to two lists of ids; the table itself is read once
    more and flagged by them.
    """
    own = tweets.where(F.col("author_id") == brand)
    asked = own.select(F.col("tweet_id").alias("_of")).where(F.col("_of").isNotNull()).distinct()
    answered = own.select(F.col("in_response_to_tweet_id").alias("_id")).where(F.col("_id").isNotNull()).distinct()
    flagged = tweets.join(asked, F.col("in_response_to_tweet_id") == F.col("_of"), "left")
    flagged = flagged.join(answered, F.col("tweet_id") == F.col("_id"), "left")
    part = F.when(F.col("author_id") == brand, 0).when(F.col("_of").isNotNull(), 1).when(F.col("_id").isNotNull(), 2)
    tagged = flagged.select(*tweets.columns, part.alias("_part")).where("_part IS NOT NULL")
    return skew.first_per_key(tagged, ["tweet_id"], [F.col("_part")]).drop("_part")
