import re

import numpy as np
import pytest
import xxhash

from caseloom.llm import simhash


def plain_print(text, k=4):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute(fps, ids, radius):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(fps)):
        if ids[i] is not None:
            groups[find(i)] = min(groups.get(find(i), ids[i]), ids[i])
    return [groups.get(find(i)) for i in range(len(fps))]


TEXTS = ["A b C d e", "a B c d E", "", None, " \t\n", "one", "x y z", "é À b", "w " * 3000, "a\x0bb\x1cc d e"]


def test_prints():
    for t in TEXTS:
        assert simhash.simhash(t) == plain_print(t)
        assert simhash.simhash(t, 5) == plain_print(t, 5)


def test_documents(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(TEXTS)] + [(None, "one", "y", 2), (3, None, "z", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id int")
    fps = [plain_print(r[1]) for r in rows]
    want = brute(fps, [r[0] for r in rows], 4)
    got = simhash.near_duplicates(df).collect()
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == sorted(
        (str(r[0]), f"{f:016x}", str(w)) for r, f, w in zip(rows, fps, want)
    )
    assert simhash.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("prune", [True, False])
def test_links_lose_no_pair(spark, prune):
    rng = np.random.default_rng(5)
    fps = []
    for _ in range(25):
        base = int(rng.integers(0, 1 << 63)) * 2 + int(rng.integers(0, 2))
        for _ in range(4):
            fps.append(base)
            for b in rng.choice(64, int(rng.integers(1, 5)), replace=False):
                base ^= 1 << int(b)
    fps = sorted(set(fps))
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    pairs = simhash.links(df, 4, prune)
    roots = {np.int64(r.node).view(np.uint64).item(): np.int64(r.root).view(np.uint64).item() for r in simhash.components(pairs).collect()}
    want = brute(fps, list(range(len(fps))), 4)
    groups = {}
    for f, w in zip(fps, want):
        groups.setdefault(w, []).append(f)
    for members in groups.values():
        assert len({roots.get(f, f) for f in members}) == 1
    assert len({roots.get(f, f) for f in fps}) == len(groups)


def test_long_chain(spark):
    edges = spark.range(300).selectExpr("id AS a", "id + 1 AS b")
    got = simhash.components(edges).collect()
    assert len(got) == 301 and {r.root for r in got} == {0}


def test_odd_radius(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.range(2).selectExpr("id AS fp"), 3)
