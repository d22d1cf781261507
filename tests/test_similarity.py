"""Retrieval against brute force in NumPy."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseloom.operators import similarity as S
from caseloom.session import store
from caseloom.sources import writers

CORPUS = [
    ("c1", "my order is late and I want a refund", "Let us look into your order and refund.", "billing_issue", "v1"),
    ("c2", "I cannot log in to my account", "Please reset your password.", "account_access", "v2"),
    ("c3", "the app keeps crashing on start", "We are sorry, let us send a crash log.", "app_bug", "v3"),
    ("c4", "how do I download music for offline listening", "Open settings and tap offline downloads.", "playback_issue", "v4"),
]
SCHEMA = "case_id string, customer_message string, brand_reply string, intent string, conversation_id string"


def brute(docs: dict, queries: dict, k: int, max_features: int, stops=()):
    def words(t):
        return [w for w in re.findall(r"\b\w\w+\b", (t or "").lower()) if w not in stops]

    frequency = Counter(w for t in docs.values() for w in words(t))
    vocab = [w for w, _ in sorted(frequency.items(), key=lambda x: (-x[1], x[0]))[:max_features]]
    at = {w: i for i, w in enumerate(vocab)}
    df = Counter(w for t in docs.values() for w in set(words(t)))
    idf = np.array([np.log((1 + len(docs)) / (1 + df[w])) + 1 for w in vocab])

    def matrix(texts):
        m = np.zeros((len(texts), len(vocab)))
        for i, t in enumerate(texts):
            for w in words(t):
                if w in at:
                    m[i, at[w]] += 1
        m *= idf
        n = np.linalg.norm(m, axis=1, keepdims=True)
        return m / np.where(n == 0, 1, n)

    ids = list(docs)
    scores = matrix(list(queries.values())) @ matrix(list(docs.values())).T
    out = {}
    for q, row in zip(queries, scores):
        best = sorted(range(len(ids)), key=lambda j: (-round(row[j], 9), ids[j]))[:k]
        out[q] = [(ids[j], round(row[j], 4)) for j in best if row[j] > 1e-12]
    return out


@pytest.fixture(scope="module")
def index(spark):
    return S.build_index(spark.createDataFrame(CORPUS, SCHEMA), keep=store)


def ask(spark, index, texts, **options):
    q = spark.createDataFrame(list(enumerate(texts)), "message_id long, message string")
    return [r["retrieval"] for r in S.retrieve(q, index, **options).orderBy("message_id").collect()]


def test_small_corpus(spark, index):
    best, late, blank, missing, unknown = ask(
        spark, index, ["I cannot log in to my account", "my order is late refund", "", None, "zzzz qqqq"], min_similarity=0.1
    )
    assert best["top_cases"][0]["intent"] == "account_access" and best["top_similarity"] == 1.0
    assert best["sufficient"] and late["n_results"] <= 3
    scores = [c["similarity_score"] for c in late["top_cases"]]
    assert scores == sorted(scores, reverse=True)
    assert late["top_cases"][0]["brand_reply"] == "Let us look into your order and refund."
    for r in (blank, missing, unknown):
        assert (r["sufficient"], r["top_cases"], r["top_similarity"], r["n_results"]) == (False, [], 0.0, 0)


def test_threshold_and_k(spark, index):
    assert not ask(spark, index, ["my order is late refund now app start"], min_similarity=0.99)[0]["sufficient"]
    assert ask(spark, index, ["refund app account music"], top_k=2)[0]["n_results"] == 2


@pytest.fixture(scope="module")
def big(spark):
    """Skewed texts: one frequent word everywhere, a third of the corpus being copies of one message."""
    rng = np.random.default_rng(5)
    names = [f"w{i}" for i in range(120)]
    p = 1 / np.arange(1, 121)
    p /= p.sum()

    def text():
        return " ".join(rng.choice(names, size=rng.integers(1, 9), p=p))

    docs = {i: ("w0 w1 w7" if i % 3 == 0 else text()) for i in range(300)}
    queries = {i: ("w0 w3" if i % 3 == 0 else text()) for i in range(90)} | {1000: "w0", 1001: "", 1002: "nothing"}
    cases = spark.createDataFrame(
        [(i, i, t, f"r{i}", "other", str(i), f"CASE_{i}") for i, t in docs.items()],
        "customer_tweet_id long, brand_tweet_id long, customer_message string, brand_reply string, intent string, "
        "conversation_id string, case_id string",
    )
    index = S.build_index(cases, (), 100, keep=store)
    asked = spark.createDataFrame(list(queries.items()), "message_id long, message string")
    return index, asked, brute(docs, queries, 3, 100)


@pytest.mark.parametrize("options", [{}, {"budget": 1}, {"budget": 20}, {"budget": 200}, {"budget": 10**9}], ids=str)
def test_every_way_equals_brute_force(big, options):
    index, asked, want = big
    got = {
        r["message_id"]: [(int(c["customer_tweet_id"]), c["similarity_score"]) for c in r["retrieval"]["top_cases"]]
        for r in S.retrieve(asked, index, **options).collect()
    }
    assert got.keys() == want.keys()
    for q in want:
        assert [d for d, _ in got[q]] == [d for d, _ in want[q]], q
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]], abs=2e-4)


@pytest.mark.parametrize("entries", [10**6, 400], ids=str)
def test_products_of_blocks(big, monkeypatch, entries):
    """Many queries are answered without a row for a pair of a query and a posting, and with the same answers."""
    index, asked, want = big
    monkeypatch.setattr(S, "MOST_PAIRS", 0)
    monkeypatch.setattr(S, "_search_blocks", None)
    monkeypatch.setattr(S.products.best_of_blocks, "__defaults__", (entries,))
    monkeypatch.setattr(S.products, "LEAST", 100)
    found = {
        r["message_id"]: [(int(c["customer_tweet_id"]), c["similarity_score"]) for c in r["retrieval"]["top_cases"]]
        for r in S.retrieve(asked, index).collect()
    }
    assert found.keys() == want.keys()
    for q in want:
        assert [d for d, _ in found[q]] == [d for d, _ in want[q]], q
        assert [s for _, s in found[q]] == pytest.approx([s for _, s in want[q]], abs=2e-4)


def test_rows_of_a_round_are_bounded_with_their_other_terms(big, monkeypatch):
    """Few enough pairs, which every skipped term of their query would multiply, are answered without rows of them."""
    index, asked, want = big
    monkeypatch.setattr(S, "MOST_PAIRS", 20 * asked.count())
    monkeypatch.setattr(S, "_search_blocks", None)
    found = {r["message_id"]: [int(c["customer_tweet_id"]) for c in r["retrieval"]["top_cases"]] for r in S.retrieve(asked, index, budget=20).collect()}
    assert found == {q: [d for d, _ in hits] for q, hits in want.items()}


def test_copies_are_indexed_once(big):
    index, _, _ = big
    assert 290 < index.members.count() <= 300
    assert index.postings.select("vec_id").distinct().count() < 210


def test_grouping_keeps_every_reply(spark):
    data = [(1, b, "hello", f"r{b:03d}", "x", "1", "CASE_1") for b in range(25)] + [(2, 99, "bye", None, None, "2", "CASE_2"), (None, 7, "n", "n", "n", "n", "n")]
    cases = spark.createDataFrame(
        data,
        "customer_tweet_id long, brand_tweet_id long, customer_message string, brand_reply string, intent string, conversation_id string, case_id string",
    )
    grouped = {r["doc_id"]: r for r in S.group_cases(S.fill_cases(cases)).collect()}
    assert set(grouped) == {1, 2} and grouped[1]["n_replies"] == 25 and grouped[1]["brand_reply"] == "r000"
    assert grouped[2]["brand_reply"] == "" and grouped[2]["intent"] == "other"
    replies = [(r["reply_order"], r["brand_reply"]) for r in S.replies_of(cases).collect() if r["doc_id"] == 1]
    assert sorted(replies) == [(b, f"r{b:03d}") for b in range(25)]


def test_a_message_with_very_many_replies(spark):
    cases = spark.range(2500).selectExpr(
        "1L AS customer_tweet_id", "id AS brand_tweet_id", "'login help' AS customer_message", "concat('r', id) AS brand_reply",
        "'x' AS intent", "'1' AS conversation_id", "'CASE_1' AS case_id",
    )
    index = S.build_index(cases, (), keep=store)
    q = spark.createDataFrame([(0, "login help")], "message_id long, message string")
    done = store(S.retrieve(q, index))
    top = done.first()["retrieval"]["top_cases"][0]
    assert (top["n_replies"], top["brand_reply"]) == (2500, "r0")
    assert S.evidence_replies(done, index).select("brand_reply").distinct().count() == 2500


def test_evidence_replies(spark, index):
    q = spark.createDataFrame([(0, "I cannot log in to my account")], "message_id long, message string")
    shown = S.evidence_replies(S.retrieve(q, index), index)
    assert ("c2", "Please reset your password.") in [(r["case_id"], r["brand_reply"]) for r in shown.collect()]


def test_index_round_trip(spark, index, tmp_path):
    cases = spark.createDataFrame(CORPUS, SCHEMA)
    path = str(tmp_path / "index")
    assert writers.load_index(spark, path) is None
    loaded = writers.load_or_build_index(spark, path, cases)
    again = writers.load_or_build_index(spark, path, None)
    text = ["my order is late refund"]
    assert ask(spark, loaded, text) == ask(spark, again, text) == ask(spark, index, text)
    loaded.cases.drop("n_replies").write.parquet(str(tmp_path / "old" / "cases"))
    assert writers.load_index(spark, str(tmp_path / "old")) is None


def test_vocabulary_tie_break_and_idf(spark):
    docs = spark.createDataFrame([(1, "bb aa aa"), (2, "bb cc")], "d long, t string")
    counts = S.term_counts(docs, "d", "t")
    got = S.vocabulary(counts, S.n_rows(docs), 2).orderBy("term").collect()
    assert [(r["term"], r["frequency"], r["df"]) for r in got] == [("aa", 2, 1), ("bb", 2, 2)]
    assert got[0]["idf"] == pytest.approx(np.log(3 / 2) + 1) and got[1]["idf"] == pytest.approx(1)
    norms = S.tfidf(counts, S.vocabulary(counts, S.n_rows(docs))).groupBy("doc_id").agg(F.sum(F.col("weight") ** 2).alias("n"))
    assert [r["n"] for r in norms.collect()] == pytest.approx([1, 1])


def test_blocks_are_skipped(spark):
    """Of a term that all documents have, only the blocks of large weights are read, and the answers are those of reading all."""
    cases = spark.range(4000).selectExpr(
        "id AS customer_tweet_id", "id AS brand_tweet_id",
        "concat('common ', repeat(concat('w', id % 50, ' '), cast(id % 40 as int)), 'u', id) AS customer_message",
        "'r' AS brand_reply", "'x' AS intent", "'1' AS conversation_id", "'CASE' AS case_id",
    )
    index = S.build_index(cases, (), 5000, keep=store)
    q = store(spark.createDataFrame([(1, "common", 1.0)], "q_key long, term string, q_weight double"))
    whole = index.blocks.where("term = 'common'")
    assert whole.count() > 5 and whole.agg(F.sum("n")).first()[0] == 4000
    plan = store(S._reading_plan(q, index.blocks, 300))
    read = plan.select(F.inline("terms")).select("term", F.explode("levels").alias("level")).join(index.blocks, ["term", "level"])
    assert read.agg(F.sum("n")).first()[0] <= 300 and plan.first()["sums"] > 0
    found = S._search_blocks(plan, index.postings, 3).first()
    assert found["settled"]
    every = S.search(q, index, 3, 10**9).orderBy(F.desc("rank_score"), "vec_id").collect()
    assert [t["vec_id"] for t in found["top"]] == [r["vec_id"] for r in every]
    maxima = index.postings.groupBy("term", "level").agg(F.max("weight").alias("w")).join(index.blocks, ["term", "level"])
    assert maxima.where("w <> top").isEmpty()


def test_few_messages_read_few_pages(spark, rows, tmp_path):
    """A stored index finds what the built one does, and opens only the pages of the terms asked for."""
    words = [f"word{i}" for i in range(60)]
    data = [(i, i, f"CASE_{i}", str(i), "other", f"{words[i]} {words[(7 * i) % 60]} common", f"reply {i}") for i in range(60)]
    schema = "customer_tweet_id long, brand_tweet_id long, case_id string, conversation_id string, intent string, customer_message string, brand_reply string"
    built = S.build_index(rows(data, schema), (), keep=store)
    loaded = writers.load_index(spark, writers.save_index(built, str(tmp_path / "i"), pages=16))
    assert loaded.pages == 16
    asked = rows([(1, "word3"), (2, "none of them")], "message_id long, message string")
    want = sorted(map(str, S.retrieve(asked, built, keep=store).collect()))
    assert sorted(map(str, S.retrieve(asked, loaded, keep=store).collect())) == want
    terms = rows([("word3",)], "term string")
    some = S.in_pages(loaded, "postings", terms)
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "page#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert 0 < some.count() < loaded.postings.count() / 4


def test_cases_are_grouped_where_the_join_left_them(spark, tmp_path):
    """Pairs made by a shuffled join are grouped without another shuffle, and the join is made once."""
    from caseloom.operators import cases as K

    spark.range(400).selectExpr("id AS tweet_id", "'u' AS author_id", "true AS inbound", "'' AS created_at", "'m' AS text", "CAST(NULL AS BIGINT) AS in_response_to_tweet_id").union(
        spark.range(900).selectExpr("id + 10000", "'b'", "false", "''", "concat('r', id)", "id % 300")
    ).write.parquet(str(tmp_path / "t"))
    tweets = spark.read.parquet(str(tmp_path / "t"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        rows = K.build_cases(tweets).withColumn("intent", F.lit("other"))
        grouped = S.group_cases(rows)
        assert grouped._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
        got = {r["doc_id"]: (r["brand_reply"], r["n_replies"]) for r in grouped.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == {i: (f"r{i}", 3) for i in range(300)}


def test_counts_are_not_shuffled_by_document_again(spark, tmp_path):
    spark.range(50).selectExpr("id AS d", "concat('aa bb w', id) AS t").write.parquet(str(tmp_path / "t"))
    docs = spark.read.parquet(str(tmp_path / "t"))
    counts = S.term_counts(docs, "d", "t")
    plan = S.tfidf(counts, S.vocabulary(counts, S.n_rows(docs)))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(doc_id" in plan and "hashpartitioning(doc_id#" in plan
    import re

    assert not re.search(r"hashpartitioning\(doc_id#\d+L?, term", plan)
