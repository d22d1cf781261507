import re

import pytest
from pyspark.sql import functions as F

from caseloom import config
from caseloom.functions import jsonparse
from caseloom.functions import text as X


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "t string").select(column.alias("r")).first()["r"]


def test_white_space_is_what_python_strips():
    every = {chr(c) for c in range(0x10000) if re.fullmatch(r"\s", chr(c))}
    assert set(X.SPACES) == every


def test_collapse_covers_every_space(spark):
    text = "a" + "b".join(X.SPACES) + "c"
    assert one(spark, X.collapse_whitespace("t"), text) == " ".join(text.split())


@pytest.mark.parametrize(
    "value, stripped, collapsed, blank",
    [
        (None, None, "", True),
        ("", "", "", True),
        (" \t\n 　", "", "", True),
        (" a \n b ", "a \n b", "a b", False),
        ("x", "x", "x", False),
    ],
)
def test_strip_collapse_blank(spark, value, stripped, collapsed, blank):
    assert one(spark, X.strip("t"), value) == stripped
    assert one(spark, X.collapse_whitespace("t"), value) == collapsed
    assert one(spark, X.is_blank("t"), value) is blank


@pytest.mark.parametrize(
    "value, label",
    [
        ("I was CHARGED twice", "billing_issue"),
        ("my premium account", "subscription_issue"),
        ("cannot log in, app crash", "account_access"),
        ("the playlist", "playback_issue"),
        ("app won't open", "app_bug"),
        ("lyrics?", "feature_inquiry"),
        ("hello", "other"),
        ("my address", "feature_inquiry"),
        (None, "other"),
    ],
)
def test_first_label(spark, value, label):
    assert one(spark, X.first_label("t", config.INTENT_RULES, "other"), value) == label


def test_null_label(spark):
    assert one(spark, X.first_label("t", config.INTENT_RULES, "other", "unknown"), None) == "unknown"


def test_matching_keeps_needle_order(spark):
    assert one(spark, X.matching("t", ("b", "a", "zz")), "A b") == ["b", "a"]
    assert one(spark, X.matching("t", ("sue",)), "an issue") == ["sue"]
    assert one(spark, X.matching("t", ("sue",), True), "an issue") == []
    assert one(spark, X.matching("t", ("sue",), True), "I will sue you") == ["sue"]
    assert one(spark, X.matching("t", ("sue",)), None) == []


def test_regex_hits_by_pattern_then_position(spark):
    text = "YOUR order has been sent. Your bill has been paid"
    assert one(spark, X.regex_hits("t", (r"has been", r"your (\w+)")), text) == ["has been", "has been", "YOUR order", "Your bill"]


def test_tokens_as_two_or_more_word_characters(spark):
    text = "I can't log_in À l'Été 2x, a 中文"
    assert one(spark, X.tokens("t"), text) == re.findall(r"\b\w\w+\b", text.lower())


@pytest.mark.parametrize(
    "value, seconds",
    [
        ("Tue Oct 31 22:10:47 +0000 2017", 1509487847),
        ("Tue Oct 31 22:10:47 +0200 2017", 1509480647),
        ("2017-10-31 22:10:47", 1509487847),
        ("not a date", None),
        ("Tue Oct 99 22:10:47 +0000 2017", None),
        (None, None),
    ],
)
def test_parse_when(spark, value, seconds):
    assert one(spark, F.unix_seconds(X.parse_when("t")), value) == seconds


@pytest.mark.parametrize(
    "raw, a",
    [
        ('{"a": 1}', 1),
        ('```json\n{"a": 1}\n```', 1),
        ('```\n{"a": 1}```', 1),
        ('Sure! {"a": 1} Bye', 1),
        ('  {"a": {"b": "}"}, "a2": 1} ', None),
        ('{"a": ', None),
        ("}{", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_json(spark, raw, a):
    assert one(spark, F.try_variant_get(jsonparse.parse_json(F.col("t")), "$.a", "int"), raw) == a


def test_only_objects(spark):
    assert one(spark, jsonparse.parse_object(F.col("t")).isNull(), "[1]") is True
    assert one(spark, jsonparse.parse_object(F.col("t")).isNull(), "{}") is False
