import pytest
from pyspark.sql import functions as F

from caseloom.operators import brands, cases, labels, profile, skew, windows

TWEETS = "tweet_id long, author_id string, inbound boolean, created_at string, text string, in_response_to_tweet_id long"
DAY = "Tue Oct 31 22:{:02d}:00 +0000 2017"
DATA = [
    (1, "100", True, DAY.format(0), "help me", None),
    (2, "acme", False, DAY.format(10), "hi", 1),
    (3, "acme", False, DAY.format(5), "again", 1),
    (4, "100", True, "bad date", "thanks", 2),
    (5, "acme", False, DAY.format(20), "welcome", 4),
    (6, "other", False, DAY.format(0), "lost", 99),
    (7, "200", True, DAY.format(30), "  ", None),
    (8, "other", False, DAY.format(25), "early", 7),
]


@pytest.fixture
def tweets(rows):
    return rows(DATA, TWEETS)


def by(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_pairs_are_one_to_many(tweets):
    assert by(cases.build_cases(tweets), "customer_tweet_id", "brand_tweet_id") == [(1, 2), (1, 3), (4, 5), (7, 8)]


def test_latency_is_signed_and_null_without_a_date(tweets):
    got = {r["brand_tweet_id"]: r["reply_time_minutes"] for r in cases.build_cases(tweets).collect()}
    assert got == {2: 10.0, 3: 5.0, 5: None, 8: -5.0}


def test_case_columns(tweets):
    df = cases.build_cases(tweets)
    assert df.columns[-2:] == ["conversation_id", "case_id"]
    assert by(df, "case_id")[0] == ("CASE_1",)


def test_validity(rows):
    data = [(1, 1, "a", "x"), (1, 1, "a", "x"), (1, 1, None, "x"), (2, 2, " ", "y"), (3, 3, "b", ""), (4, 4, "c", "z")]
    df = rows(data, "customer_tweet_id long, brand_tweet_id long, customer_message string, brand_reply string")
    parted = cases.partition_cases(df)
    assert parted.count() == len(data)
    assert by(parted.where("is_valid"), "customer_tweet_id") == [(4,)]
    assert by(cases.valid_cases(df), "customer_tweet_id") == [(4,)]
    report = cases.case_quality(df).first().asDict()
    assert report == {
        "total_candidate_pairs": 6,
        "valid_pairs": 1,
        "removed_pairs": 5,
        "missing_customer_messages": 2,
        "missing_brand_replies": 1,
        "duplicates": 2,
        "other_invalid_cases": 0,
    }


def test_clean_text_drops_duplicates(rows):
    df = cases.clean_text(rows([("a  b",), ("a  b",), (None,)], "text string"))
    assert sorted((r["original_text"] or "", r["clean_text"]) for r in df.collect()) == [("", ""), ("a  b", "a b")]


def test_brand_subset(tweets):
    assert by(brands.brand_subset(tweets, "acme"), "tweet_id") == [(1,), (2,), (3,), (4,), (5,)]


def test_brand_subset_keeps_one_row_per_id(rows):
    data = DATA + [(4, "100", True, None, "another text", 2)]
    assert brands.brand_subset(rows(data, TWEETS), "acme").where("tweet_id = 4").count() == 1


@pytest.mark.parametrize(
    "low, high, brand", [(10_000, 50_000, "b04"), (1_000_000, 2_000_000, "b06"), (100_000, 200_000, "b01")]
)
def test_select_brand(rows, low, high, brand):
    # Published volumes of the first four brands; the rest falls off.
    volumes = [169840, 106860, 56000, 43265, 40000, 39000, 30000]
    df = rows([(f"b{i:02d}", v) for i, v in enumerate(volumes, 1)], "brand string, replies long")
    picked = brands.select_brand(df, low, high).first()
    assert picked["brand"] == brand and picked["tweets"] == 2 * picked["brand_replies"]


def test_select_brand_with_too_few(rows):
    df = rows([("a", 1)], "brand string, replies long")
    assert brands.select_brand(df, 5, 6).count() == 0


def test_message_quality(rows):
    schema = TWEETS.replace("inbound boolean", "inbound string")
    data = [
        (1, "a", "True", DAY.format(1), "hello", None),
        (1, "a", "True", DAY.format(1), "hello", None),
        (2, "a", "false", "bad", "x", 1),
        (3, "a", "maybe", None, "y" * 301, 1),
        (4, "a", None, DAY.format(2), None, 1),
    ]
    got = profile.message_quality(rows(data, schema)).first().asDict()
    assert got == {
        "duplicate_rows": 1,
        "missing_text": 1,
        "invalid_timestamps": 2,
        "short_messages": 1,
        "long_messages": 1,
        "missing_reply_link": 2,
        "unexpected_inbound": 2,
    }


def test_column_roles(spark, tweets):
    got = by(profile.column_roles(spark, tweets), "role", "column_name")
    assert got == [("brand", "author_id"), ("reply", "in_response_to_tweet_id"), ("time", "created_at")]


def test_duplicate_rows_null_equals_null(rows):
    assert profile.duplicate_rows(rows([(1, None), (1, None), (1, "a")], "a int, b string")).first()[0] == 1


def test_length_statistics_match_pandas(rows):
    import pandas as pd

    texts = ["a" * n for n in (1, 5, 5, 9, 40)]
    want = pd.Series([len(t) for t in texts]).describe()
    got = profile.length_statistics(rows([(t,) for t in texts] + [(None,)], "text string")).first()
    assert list(got)[:3] == pytest.approx([want["count"], want["mean"], want["std"]])
    assert list(got)[3:] == [want["min"], want["25%"], want["50%"], want["75%"], want["max"]]


def test_histogram_keeps_empty_bins(rows):
    df = profile.length_histogram(rows([("a" * n,) for n in (1, 1, 51)], "text string"))
    got = dict(by(df, "bin", "n"))
    assert len(got) == 50 and got[0] == 2 and got[49] == 1 and sum(got.values()) == 3


def test_null_and_direction_counts(tweets):
    assert dict(by(profile.null_counts(tweets), "column_name", "missing"))["in_response_to_tweet_id"] == 2
    assert dict(by(profile.direction_counts(tweets), "inbound", "n")) == {True: 3, False: 5}


def test_rules_from_table(rows):
    df = rows([(2, "b", "x"), (1, "a", "z"), (1, "a", "y")], "priority int, label string, keyword string")
    texts = rows([(1, "X and Y"), (2, "mere x"), (3, "none"), (4, None)], "n int, customer_message string")
    got = dict(by(labels.label_by_table(texts, df), "n", "intent"))
    assert got == {1: "a", 2: "b", 3: "other", 4: "other"}


def test_twenty_thousand_rules(spark, rows):
    rules = spark.range(20_000).selectExpr("CAST(id AS INT) AS priority", "concat('l', id) AS label", "concat('<', id, '>') AS keyword")
    texts = rows([(1, "a <19999> b <7>"), (2, "<19999>")], "n int, customer_message string")
    assert dict(by(labels.label_by_table(texts, rules), "n", "intent")) == {1: "l7", 2: "l19999"}


def test_rules_inside_characters_pieces_and_copies(rows, monkeypatch):
    """Against a search one by one: keywords over the cuts of a long text, beside emoji, empty ones, repeated texts."""
    monkeypatch.setattr(labels, "PIECE", 5)
    words = ["?ab", "abab", "b\U0001f600a", "\U0001f600", "line\nend", "zz", "ba", "a.c", "longer than a piece"]
    texts = ["\U0001f600ab", "xababab", "ab\U0001f600ab", "Line\nEND", "", None, "abc", "a.c", "it is LONGER than a piece, ba", "abc"]
    rules = rows([(i % 3, f"l{i}", w) for i, w in enumerate(words)] + [(9, "none", None)], "priority int, label string, keyword string")
    df = rows(list(enumerate(texts)), "n int, customer_message string")
    ordered = sorted((i % 3, w, f"l{i}") for i, w in enumerate(words))
    inside = {n: [r for r in ordered if t is not None and r[1] in t.lower()] for n, t in enumerate(texts)}
    got = dict(by(labels.label_by_table(df, rules), "n", "intent"))
    assert got == {n: (found[0][2] if found else "other") for n, found in inside.items()}
    hits = labels.keyword_hits_by_table(df, rules)
    assert sorted((r["n"], r["keyword"]) for r in hits.collect()) == sorted((n, r[1]) for n, found in inside.items() for r in found)
    with_empty = rules.unionByName(rows([(50, "all", "")], "priority int, label string, keyword string"))
    got = dict(by(labels.label_by_table(df, with_empty), "n", "intent"))
    assert got[4] == "all" and got[5] == "other" and got[7] == "l7"
    none = rules.where("false")
    assert set(dict(by(labels.label_by_table(df, none), "n", "intent")).values()) == {"other"}


def test_substrings_that_are_no_keywords_stay_in_their_task(spark, rows):
    """Of 4,000 characters and 40 lengths of keywords only what may be a keyword is handed on."""
    rules = spark.range(2_000).selectExpr("CAST(id AS INT) AS priority", "'l' AS label", "rpad(concat('k', id), 5 + id % 40, 'x') AS keyword")
    texts = rows([(1, "".join(f"w{i} " for i in range(800)) + "k7xxxxxxxxxx")], "n int, customer_message string")
    found = labels.rule_matches(texts, rules, "customer_message")
    assert {r["keyword"] for r in found.collect()} == {"k7xxxxxxxxxx"}
    handed = windows.find(texts, "customer_message", ["n"], rules, "keyword", 100)
    assert {r["keyword"] for r in handed.collect()} >= {"k7xxxxxxxxxx"} and handed.count() < 2_000


def test_distribution_sums_to_hundred(tweets):
    df = profile.distribution(tweets, "author_id")
    assert sum(r["percentage"] for r in df.collect()) == pytest.approx(100)


def test_first_per_key_prefers_the_given_order(rows):
    df = rows([(1, "b", 0), (1, "a", 1)], "k int, v string, o int")
    assert skew.first_per_key(df, ["k"], [F.col("o")]).first()["v"] == "b"
    assert skew.first_per_key(df, ["k"]).first()["v"] == "a"
