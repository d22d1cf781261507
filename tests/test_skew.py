"""Hot keys, copies and partition counts must not change results."""

import pytest
from pyspark.sql import functions as F

from caseloom.functions.text import seeded_order
from caseloom.operators import skew


@pytest.fixture
def skewed(spark):
    """A third of the rows have key 0."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )


def test_joins_name_no_keys(spark):
    """1,500 hot keys are joined like any others: by a plain join, which adaptive execution may split."""
    from caseloom.operators import cases

    rows = spark.range(1500).selectExpr("id AS tweet_id", "'u' AS author_id", "true AS inbound", "'' AS created_at", "'m' AS text", "CAST(NULL AS BIGINT) AS in_response_to_tweet_id")
    answers = spark.range(6000).selectExpr("id + 10000", "'b'", "false", "''", "'r'", "id % 1500")
    pairs = cases.pair_messages(rows.union(answers))
    assert pairs.count() == 6000 and pairs.select("customer_tweet_id").distinct().count() == 1500
    plan = pairs._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "Expand" not in plan


@pytest.mark.parametrize("n", [1, 3, 50])
def test_top_n_with_and_without_spread(skewed, n):
    order = [F.desc("v")]
    want = sorted(map(tuple, skew.top_n_per_group(skewed, ["k"], order, n).collect()))
    spread = skew.top_n_per_group(skewed, ["k"], order, n, spread=F.col("v"), rows_per_salt=100)
    assert sorted(map(tuple, spread.collect())) == want
    assert sum(1 for k, _ in want if k == 0) == n


def test_top_n_cuts_before_the_shuffle(skewed):
    plan = skew.top_n_per_group(skewed, ["k"], [F.desc("v")], 5)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_rows_are_not_dealt_out_by_group(spark, tmp_path):
    """A table whose size forbids a broadcast: the few groups go to its rows, so no task gets all rows of a group."""
    text = F.sha2(F.col("id").cast("string"), 512)
    spark.range(0, 40_000, 1, 4).select("id", (F.col("id") % 2).alias("g"), text.alias("text")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 100_000)
    try:
        top = skew.top_n_per_group(df, ["g"], [seeded_order(1, "id"), F.col("id")], 3, spread=F.col("id"))
        split = skew.smallest_share(df, "g", seeded_order(1, "id"), ["id"], 0.15)
        for made, n in ((top, 6), (split, 40_000)):
            assert made.count() == n
            plan = made._jdf.queryExecution().sparkPlan().toString()
            assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan and "BroadcastHashJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize(("limit", "pieces"), [(1000, 1), (2, 150)])
def test_pieces_by_the_rows_that_reach_the_cut(spark, monkeypatch, limit, pieces):
    """Tasks that send three rows of a group need one piece of it, whatever its size; those that send all rows need many."""
    df = spark.range(0, 30_000, 1, 4).select("id", (F.col("id") % 2).alias("g"))
    seen, cut = [], skew._cut
    monkeypatch.setattr(skew, "_cut", lambda d, *a: seen.append(d) or cut(d, *a))
    name = "spark.sql.optimizer.windowGroupLimitThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, limit)
    try:
        got = skew.top_n_per_group(df, ["g"], [F.desc("id")], 3, spread=F.col("id"), rows_per_salt=100)
        assert sorted(r["id"] for r in got.collect()) == list(range(29_994, 30_000))
        assert {r["_salts"] for r in seen[0].select("_salts").distinct().collect()} == {pieces}
    finally:
        spark.conf.set(name, before)


@pytest.mark.parametrize("share", [0.0, 0.15, 0.5, 1.0])
def test_smallest_share_is_exact(spark, share):
    df = spark.range(2000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g")
    )
    got = skew.smallest_share(df, "g", seeded_order(1, "id"), ["id"], share).collect()
    assert len(got) == 2000
    import hashlib
    from decimal import ROUND_CEILING, Decimal

    groups: dict = {}
    for r in got:
        groups.setdefault(r["g"], []).append(r)
    for rows in groups.values():
        n = int((Decimal(str(share)) * len(rows)).to_integral_value(ROUND_CEILING))
        ordered = sorted(rows, key=lambda r: (hashlib.md5(f"1|{r['id']}".encode()).hexdigest(), r["id"]))
        assert {r["id"] for r in rows if r["picked"]} == {r["id"] for r in ordered[:n]}


def test_mark_duplicates_with_a_group_of_copies(rows):
    data = [("k", "x")] * 50 + [("k", "y")] * 3 + [("k", "a")] + [("l", None)] * 2
    got = skew.mark_duplicates(rows(data, "k string, v string"), ["k"]).collect()
    assert len(got) == len(data)
    kept = sorted((r["k"], r["v"] or "") for r in got if not r["is_duplicate"])
    assert kept == [("k", "a"), ("l", "")]
    assert sum(1 for r in got if r["v"] == "x") == 50


@pytest.mark.parametrize("key", ["k", None])
def test_mark_duplicates_of_a_hot_key(spark, key):
    """Nine tenths of the distinct rows have one key, or none."""
    df = spark.range(1000).select(F.when(F.col("id") % 10 > 0, F.lit(key)).otherwise(F.concat(F.lit("x"), "id")).alias("k"), F.col("id").alias("v"))
    got = skew.mark_duplicates(df, ["k"]).collect()
    assert len(got) == 1000 and sum(not r["is_duplicate"] for r in got) == 101
    assert [r["v"] for r in got if r["k"] == key and not r["is_duplicate"]] == [1]


def test_repeat_copies_in_chunks(rows):
    df = rows([("a", 25), ("b", 1), ("c", 10)], "v string, n long")
    got = [r["v"] for r in skew.repeat_copies(df, "n", chunk=4).collect()]
    assert {v: got.count(v) for v in "abc"} == {"a": 25, "b": 1, "c": 10}


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_partition_count_does_not_matter(spark, skewed, partitions):
    df = skewed.repartition(partitions)
    got = skew.top_n_per_group(df, ["k"], [seeded_order(7, "v"), F.col("v")], 2).agg(F.sum("v"), F.count("*")).first()
    want = skew.top_n_per_group(skewed, ["k"], [seeded_order(7, "v"), F.col("v")], 2).agg(F.sum("v"), F.count("*")).first()
    assert tuple(got) == tuple(want)


def test_first_rows_need_no_sort_aggregate(spark, rows):
    """Keys are counted in fixed-width buffers; wide columns are compared only where a key repeats."""
    from caseloom.operators import brands, cases

    wide = rows([("a", "x", 2), ("a", "x", 1), ("a", None, 3), (None, "y", 4), (None, "y", 4), ("b", "z", 5)], "k string, v string, w long")
    firsts = skew.first_per_key(wide, ["k"])
    assert {tuple(r) for r in firsts.collect()} == {("a", None, 3), (None, "y", 4), ("b", "z", 5)} and firsts.count() == 3
    assert [r["w"] for r in skew.first_per_key(wide.where("v = 'x'"), ["k"], [F.desc("w")]).collect()] == [2]
    assert skew.first_per_key(wide.limit(0), ["k"]).count() == 0
    messages = spark.range(40).selectExpr(
        "id AS tweet_id", "if(id % 2 = 0, 'u', 'brand') AS author_id", "id % 2 = 0 AS inbound", "'' AS created_at",
        "if(id % 8 = 1, ' ', concat('t', id)) AS text", "if(id % 2 = 1, id - 1, NULL) AS in_response_to_tweet_id",
    )
    pairs = cases.build_cases(messages.union(messages))
    for made in (cases.partition_cases(pairs), cases.valid_cases(pairs), cases.case_quality(pairs), brands.brand_subset(messages, "brand")):
        assert "SortAggregate" not in made._jdf.queryExecution().executedPlan().toString()


def test_quality_of_keys_with_sound_and_unsound_rows(rows):
    """Key 1 begins with a blank message, key 2 with a sound row, key 3 has none, key 4 only sound rows."""
    from caseloom.operators import cases

    data = [(1, 1, None, "r"), (1, 1, "m", "r"), (2, 2, "a", "r"), (2, 2, "b", " "), (2, 2, "a", "r"), (3, 3, "", "r"), (4, 4, "m", "r"), (4, 4, "n", "r")]
    df = rows(data, "customer_tweet_id long, brand_tweet_id long, customer_message string, brand_reply string")
    got = cases.case_quality(df).first().asDict()
    assert got == {
        "total_candidate_pairs": 8, "valid_pairs": 2, "removed_pairs": 6, "missing_customer_messages": 2,
        "missing_brand_replies": 1, "duplicates": 4, "other_invalid_cases": 0,
    }
    assert cases.case_quality(df.limit(0)).first()["total_candidate_pairs"] == 0
