"""Collocations against counting everything."""

import re
from collections import Counter

import numpy as np
import pytest

from caseloom.llm import collocations as C


def plain(rows, top, least):
    counts, total = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for n in (1, 2, 3):
                for i in range(len(words) - n + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + n])] += 1
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        dropped = {q for p, a in found.items() if len(p) == 3 for q in (p[:2], p[1:]) if q in found and 100 * a >= 50 * found[q]}
        rows = []
        for p, a in found.items():
            if p not in dropped:
                score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top]):
            out.append((lang, i + 1, p.decode(), -a, l, r, total[lang], -s))
    return sorted(out)


def texts(seed, n=300):
    """Few words, so that pairs come often, and fixed phrases among them."""
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(40)]
    fixed = [f"p{i} q{i} r{i % 4}" for i in range(25)]
    rows = []
    for i in range(n):
        parts = [str(rng.choice(words)) if rng.random() < 0.6 else str(rng.choice(fixed)) for _ in range(int(rng.integers(1, 30)))]
        marks = [str(rng.choice([" ", " ", " ", "\t", ", ", ". ", "\n", " X-"])) for _ in parts]
        rows.append((["en", "de", None][i % 3], "".join(a + b for a, b in zip(parts, marks))))
    return rows


EDGES = [("en", None), (None, ""), ("en", "É é É é " * 12), ("en", "a a a a a a a a a a a a a"), ("fr", "one two " * 9 + "."), ("und", "NUL\x00 x\x1cy " * 11), ("en", "z " * 5000)]


@pytest.mark.parametrize("top", [20, 2000])
def test_against_counting_everything(spark, top):
    rows = texts(top) + EDGES
    df = spark.createDataFrame(rows, "lang string, text string").selectExpr("*", "'x' AS w1", "1 AS n", "2 AS a").repartition(3)
    got = C.collocations(df, top=top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and {t for c, t in got.dtypes[3:]} == {"bigint"}
    assert sorted(map(tuple, got.collect())) == plain(rows, top, 10)


def test_rounds_and_full_bitmaps(spark, monkeypatch):
    """Thresholds that start too high, and bitmaps too small to tell anything, change nothing."""
    rows = texts(7)
    df = spark.createDataFrame(rows, "lang string, text string")
    want = plain(rows, 30, 10)
    monkeypatch.setattr(C, "SLACK", 0.1)
    assert sorted(map(tuple, C.collocations(df, top=30).collect())) == want
    monkeypatch.setattr(C, "LEAST_BITS", 32768)
    monkeypatch.setattr(C, "MOST_BITS", 32768)
    monkeypatch.setattr(C, "CHUNK_BYTES", 1000)
    assert sorted(map(tuple, C.collocations(df, top=30).collect())) == want


def test_large_counts(spark):
    df = spark.createDataFrame([(10**15, 10**15 + 7, 3 * 10**15)], "a long, l long, r long").select(C._score("a", "l", "r").alias("s"))
    assert df.first().s == 10**6 * 10**30 // ((10**15 + 7) * 3 * 10**15)


def test_empty_table(spark):
    assert C.collocations(spark.createDataFrame([], "lang string, text string")).collect() == []


def test_bitmap(spark):
    df = spark.createDataFrame([("en", f"w{i}") for i in range(3000)] + [("de", "x")], "lang string, w1 string")
    held = C.bits(df, ["w1"])
    assert held.size == 65536
    assert held.has(C._hashes([f"w{i}".encode() for i in range(3000)], "en")).all() and held.has(C._hashes([b"x"], "de")).all()
    assert held.has(C._hashes([f"v{i}".encode() for i in range(3000)], "en")).mean() < 0.1
