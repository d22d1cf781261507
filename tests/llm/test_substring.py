import hashlib
import random
import re

import pytest

from caseloom.llm import substring


def brute(rows, window):
    """By definition: all windows of all documents in a dictionary."""
    first = {}
    split = [(i, re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())) for i, t in rows]
    for i, words in split:
        for k in range(len(words) - window + 1):
            w = tuple(words[k : k + window])
            if i is not None:
                first[w] = min(first.get(w, i), i)
    out = []
    for i, words in split:
        gone = [False] * len(words)
        for k in range(len(words) - window + 1):
            if i is not None and first[tuple(words[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((str(i), len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def got(df, window=50):
    made = substring.remove_repeats(df, window).collect()
    for r in made:
        if r.n_removed:
            assert hashlib.sha256(r.text.encode()).hexdigest() == r.kept_sha256
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in made)


@pytest.mark.parametrize("window,alphabet", [(50, 5000), (12, 4), (12, 40)])
def test_against_definition(spark, window, alphabet):
    rng = random.Random(window + alphabet)
    word = lambda: f"w{rng.randrange(alphabet)}"
    passages = [[word() for _ in range(rng.randrange(window - 3, 3 * window))] for _ in range(6)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(rng.randrange(0, 5)):
            words += rng.choice(passages) if rng.random() < 0.6 else [word() for _ in range(rng.randrange(80))]
        if rng.random() < 0.3 and words:
            words[rng.randrange(len(words))] = "changed"
        rows.append((rng.randrange(45), rng.choice([" ", "\n", " \t "]).join(words)))
    rows += rows[:3] + [(None, rows[5][1]), (7, None), (8, ""), (9, "é ß " * 100), (10, "a\xa0b " * 60), (100, "é ß " * 100)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS anchor", "'b' AS block", "0 AS hash", "2 AS n_words")
    assert got(df, window) == brute(rows, window)


def test_long_text_and_no_rows(spark):
    text = " ".join(f"x{i % 997}" for i in range(200_000))
    rows = [(1, text), (2, "start " + text), (3, "other")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert [(r[0], r[1], r[2]) for r in got(df)] == [("1", 200_000, 0), ("2", 200_001, 200_000), ("3", 1, 0)]
    assert substring.remove_repeats(df.limit(0)).count() == 0


def test_untouched_text_is_kept_as_it_is(spark):
    df = spark.createDataFrame([(1, " two  spaces \n"), (2, None)], "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in substring.remove_repeats(df).collect()) == [(1, " two  spaces \n"), (2, None)]
