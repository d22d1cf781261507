import math

import numpy as np
import pytest

from caseloom.llm import topk


def brute(rows, every, k):
    vecs = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            vecs.append((i, [int(np.floor(64 * float(np.float32(x)))) for x in v]))
    out = []
    for i, q in vecs:
        if i % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in vecs if j != i and len(v) == len(q))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("scale,n", [(0.3, 700), (0.02, 300), (5000.0, 120), (0.3, 12)])
def test_against_all_pairs(spark, monkeypatch, scale, n):
    monkeypatch.setattr(topk, "LIST_BLOCK", 128)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 20)
    rng = np.random.default_rng(n)
    rows = [(i, [float(x) for x in rng.normal(0, scale, 8)]) for i in range(n)]
    rows += [(n, None), (n + 1, [1.0, None] * 4), (n + 2, [float("nan")] * 8), (n + 3, [float("inf")] * 8), (None, [0.1] * 8)]
    rows += [(10_000, [0.1] * 3), (10_001, [0.2] * 3), (10_020, []), (10_021, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS share", "2 AS score", "'x' AS dim")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.nearest(df, 5, 7).collect())
    assert got == brute(rows, 5, 7)


def test_repeated_rows_and_ties(spark):
    rows = [(i, [0.5, 0.25]) for i in range(40)] + [(20, [0.5, 0.25]), (3, [0.5, 0.25])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.nearest(df, 20, 5).where("query_id = 0").orderBy("rank").collect()
    assert [r.vec_id for r in got] == [1, 2, 3, 3, 4]
    assert topk.nearest(df.limit(0), 20, 5).count() == 0


def test_large_components_take_part(spark):
    """Finite components of any size that 64 bits hold, beside small ones, by whole numbers."""
    rows = [(20, [1.0, 2.0]), (40, [3e6, -1.0]), (1, [3e6, 1.0]), (2, [2.0**25, 2.0**-8]), (3, [-(2.0**50), 1e9]), (4, [0.5, 0.25]), (5, [float("inf"), 1.0]), (6, [1e300, 1.0]), (60, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = {i: [math.floor(64 * x) for x in v] for i, v in rows if i not in (5, 6)}
    want = set()
    for q in (20, 40, 60):
        scored = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)
        want |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:3])}
    assert set(map(tuple, topk.nearest(df, every=20, k=3).collect())) == want
