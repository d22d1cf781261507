import hashlib
import random
import re

from pyspark.sql import functions as F

from caseloom.llm import spotsigs as S


def spots(text):
    """The signatures as tuples of words."""
    words = [w for w in re.split(r"[^\w]|_", (text or "").lower()) if w]
    found = set()
    for i, w in enumerate(words):
        if w in S.ANCHORS:
            chain = [x for x in words[i + 1 : i + 1 + S.REACH] if x not in S.ANCHORS][: S.CHAIN]
            if len(chain) == S.CHAIN:
                found.add((w, *chain))
    return found or ({("", text)} if (text or "").strip(" ") else set())


def near(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(rows):
    """By definition; rows equal in id and text count once in the order."""
    order = sorted({(i is not None, i or 0, t or "") for i, t in rows})
    out = []
    for i, t in rows:
        t = t or ""
        after = order[(order.index((i is not None, i or 0, t)) + 1) % len(order)][2]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        out.append((str(i), len(t), hashlib.sha256(edited.encode()).hexdigest(), round(near(spots(t), spots(edited)), 9), round(near(spots(t), spots(after)), 9)))
    return sorted(out)


def some_rows(n):
    rng = random.Random(n)
    words = [*S.ANCHORS[:8], *(f"w{i}" for i in range(30)), "é1", "zß"]
    return [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 60))) + rng.choice(["", ".", "\n", "😀"])) for i in range(n)]


def test_against_definition(spark):
    rows = some_rows(40)
    rows += [(50, None), (51, ""), (52, "   "), (53, "no anchors"), (54, "the only"), (55, "the of and a b"), (57, "the " * 5000 + "x y"), (60, "the a1 b1 " * 300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS sigs", "2 AS tie", "3 AS n_chars", "'x' AS head")
    got = S.edited_fingerprints(df).collect()
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got) == brute(rows)
    prints = {r.doc_id: r.fingerprint for r in got}
    for i, t in rows:
        assert len(prints[i]) == 8 * len(spots(t))
    assert prints[50] == prints[51] == prints[52] == ""
    assert prints[53] != prints[54]


def test_ties_and_small_tables(spark):
    rows = [(None, "the x y z"), (3, "the x y z"), (3, "of a1 b1 c1"), (5, "one"), (5, "one")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = S.edited_fingerprints(df).collect()
    assert len(got) == 5 and got.count(next(r for r in got if r.doc_id == 5)) == 2
    assert len({r.fingerprint for r in got}) == 3
    assert S.edited_fingerprints(df.limit(0)).count() == 0
    one = S.edited_fingerprints(df.limit(1)).first()
    assert one.near_next == 1.0


def test_similar_pairs(spark):
    rng = random.Random(3)
    rows = some_rows(30)
    for i in range(30):
        words = rows[i][1].split(" ")
        if len(words) > 10:
            words[rng.randrange(len(words))] = "w0"
        rows.append((100 + i, " ".join(words)))
    rows += [(200, rows[4][1]), (201, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    firsts = {}
    for i, t in rows:
        if spots(t):
            firsts.setdefault(frozenset(spots(t)), i)
    for level in (0.8, 0.5):
        want = {(min(i, j), max(i, j)) for a, i in firsts.items() for b, j in firsts.items() if i < j and near(a, b) >= level}
        got = {(r.a, r.b) for r in S.similar_pairs(df, level).collect()}
        assert got == want and want


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "the a b")], "doc_id long, text string").select("doc_id", S.fingerprint(S.signatures(F.col("text"))))
    assert "Python" not in df._jdf.queryExecution().toString() and "Arrow" not in df._jdf.queryExecution().toString()
