"""The bucketed layout gives the rows of the plain joins and shuffles neither side."""

import pytest
from pyspark.sql import functions as F

from caseloom.operators import brands, cases
from caseloom.sources import threads

COLUMNS = "tweet_id long, author_id string, inbound boolean, created_at string, text string, in_response_to_tweet_id long"


@pytest.fixture
def messages(spark):
    """Message 0 has a third of the answers, message 7 is there twice, message 9 has 60 copies, some ids are null."""
    asked = spark.range(200).selectExpr("id", "concat('u', id % 9)", "true", "'a'", "concat('m', id)", "CAST(NULL AS BIGINT)")
    told = spark.range(900).selectExpr("1000 + id", "concat('b', id % 3)", "false", "'b'", "concat('r', id)", "if(id % 3 = 0, 0, id % 250)")
    back = spark.range(50).selectExpr("5000 + id", "concat('u', id % 9)", "true", "'c'", "'back'", "1000 + id")
    odd = spark.createDataFrame([(7, "u7", True, "a", "again", None), (None, "u", True, "a", "no id", None), (None, "b1", False, "b", "no id", 7)] + [(9, "u9", True, "a", "copy", None)] * 60, COLUMNS)
    return spark.createDataFrame([], COLUMNS).union(asked).union(told).union(back).union(odd)


def found(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


@pytest.mark.parametrize("rows_per_bucket", [50, 100_000])
def test_same_rows(spark, messages, tmp_path, rows_per_bucket):
    extra = messages.withColumn("_n", F.lit(1)).withColumn("page", F.lit("x"))
    laid = threads.open_threads(spark, threads.save_threads(extra, f"{tmp_path}/t", rows_per_bucket))
    hot = {r["tweet_id"] for r in laid.hot_messages.collect()}
    assert hot == ({0, 9} if rows_per_bucket == 50 else set())
    pairs = cases.pair_messages(messages)
    assert found(laid.each(cases.pair_messages).select(*pairs.columns)) == found(pairs)
    for brand in ("b0", "b1", "none"):
        for join in (brands.replies_to_brand, brands.answered_by_brand):
            got = laid.each(lambda m, r, join=join: join(m, brand, r))
            assert got.columns == extra.columns and found(got) == found(join(extra, brand))


def test_no_shuffle_below_the_joins(spark, messages, tmp_path):
    laid = threads.open_threads(spark, threads.save_threads(messages, f"{tmp_path}/t", 300))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = [
            cases.pair_messages(laid.messages, laid.replies),
            brands.replies_to_brand(laid.messages, "b1", laid.replies),
            brands.answered_by_brand(laid.messages, "b1", laid.replies),
        ]
        for df in made:
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "Join" in plan and "Exchange" not in plan
            assert df.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_empty_and_written_twice(spark, messages, tmp_path):
    path = threads.save_threads(messages, f"{tmp_path}/t", 100)
    laid = threads.open_threads(spark, threads.save_threads(messages.limit(0), path, 100))
    assert laid.each(cases.pair_messages).count() == 0
