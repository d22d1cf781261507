import pytest
from pyspark.sql import functions as F

from caseloom.operators import golden as G
from caseloom.operators import labels


@pytest.fixture(scope="module")
def pool(spark):
    words = F.array(*[F.lit(w) for w in ("refund please now", "premium plan", "login fails", "hello there", "play it")])
    return labels.label_messages(
        spark.range(400).select(
            F.col("id").alias("customer_tweet_id"),
            (F.col("id") + 10_000).alias("brand_tweet_id"),
            F.concat(F.get(words, F.when(F.col("id") < 200, 0).otherwise(F.col("id") % 5).cast("int")), F.lit(" "), (F.col("id") % 150).cast("string")).alias("customer_message"),
            F.lit("reply").alias("brand_reply"),
            F.col("id").cast("string").alias("conversation_id"),
            F.concat(F.lit("CASE_"), F.col("id")).alias("case_id"),
        )
    )


@pytest.fixture(scope="module")
def gold(pool):
    return G.golden_set(pool, 10).cache()


def test_sample_sizes(pool, gold):
    sizes = {r["intent"]: r["count"] for r in pool.groupBy("intent").count().collect()}
    assert {r["intent"]: r["count"] for r in gold.groupBy("intent").count().collect()} == {k: min(10, n) for k, n in sizes.items()}


def test_sample_is_reproducible(pool, gold):
    again = G.golden_set(pool.repartition(13), 10)
    assert gold.exceptAll(again).count() == 0 and again.exceptAll(gold).count() == 0


def test_another_seed_picks_others(pool, gold):
    assert gold.select("source_case_id").exceptAll(G.golden_set(pool, 10, seed=1).select("source_case_id")).count() > 0


def test_numbers_run_through_the_labels(gold):
    numbered = sorted((int(r["example_id"][5:]), r["intent"]) for r in gold.collect())
    assert [n for n, _ in numbered] == list(range(len(numbered)))
    assert [i for _, i in numbered] == sorted(i for _, i in numbered)


def test_columns_and_constants(gold):
    assert tuple(gold.columns) == G.GOLDEN_COLUMNS
    r = gold.first()
    assert r["expected_action"] == "Resolve based on " + r["intent"]
    assert (r["escalation_reason"], r["label_source"]) == ("", "keyword_heuristic")


@pytest.mark.parametrize("n, flag", [(14, "difficult"), (15, "normal"), (200, "normal"), (201, "difficult")])
def test_difficulty_edges(rows, n, flag):
    assert rows([("x" * n,)], "customer_message string").select(G.difficulty()).first()[0] == flag


def test_null_message_is_normal(rows):
    assert rows([(None,)], "customer_message string").select(G.difficulty()).first()[0] == "normal"


def test_no_leak_after_removal(pool, gold):
    held = G.hold_out(pool, gold)
    leaks = G.leaked_messages(held, gold).count()
    clean = G.without_leaked_messages(held, gold)
    assert leaks > 0 and G.leaked_messages(clean, gold).count() == 0
    assert clean.count() == held.count() - leaks
    report = {r["check"]: r["n"] for r in G.leakage_report(pool, gold).collect()}
    assert report == {"exact_duplicate_messages": leaks, "conversation_overlap": 0}


def test_null_messages_stay(rows, gold):
    df = rows([(None, "CASE_x")], "customer_message string, case_id string")
    assert G.without_leaked_messages(df, gold).count() == 1


def test_splits_partition_the_clean_pool(pool, gold):
    splits = G.make_splits(pool, gold).cache()
    clean = G.without_leaked_messages(G.hold_out(pool, gold), gold)
    assert splits.select("case_id").exceptAll(clean.select("case_id")).count() == 0 and splits.count() == clean.count()
    import math

    for r in splits.groupBy("intent").agg(F.count("*").alias("n"), F.count_if(F.col("split") == "validation").alias("v")).collect():
        assert r["v"] == math.ceil(round(0.15 * r["n"], 9))


def test_quality_and_queue(gold):
    q = {r["metric"]: r["value"] for r in G.golden_quality(gold).collect()}
    assert q["total_examples"] == str(gold.count()) and q["label_source"] == "keyword_heuristic"
    queue = G.review_queue(gold)
    assert queue.count() == int(q["difficult_examples"])
    assert queue.columns[-2:] == ["review_status", "reviewer_notes"]


def test_reviews(rows, gold):
    first, second = (r["example_id"] for r in gold.orderBy("example_id").limit(2).collect())
    reviews = rows(
        [(first, "app_bug", "corrected"), (second, "app_bug", "verified_correct")],
        "example_id string, intent string, review_status string",
    )
    got = {r["example_id"]: r for r in G.apply_reviews(gold, reviews).collect()}
    before = {r["example_id"]: r for r in gold.collect()}
    assert (got[first]["intent"], got[first]["label_source"]) == ("app_bug", "human_corrected")
    assert got[second] == before[second] and len(got) == len(before)


def test_label_difference(rows):
    a, b = rows([("x",), ("y",), ("y",)], "intent string"), rows([("y",), ("z",)], "intent string")
    got = sorted((r["intent"], r["side"]) for r in labels.label_set_difference(a, b).collect())
    assert got == [("x", "left_only"), ("z", "right_only")]
