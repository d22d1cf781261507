import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from caseloom.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def brute(docs, capacity, end_id):
    tok = Tokenizer.from_file(PATH)
    out = set()
    for doc_id, text in docs:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, end_id]
        first = (len(ids) - 1) % capacity + 1
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            out.add((doc_id, i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    return out


def gapless(rows, capacity):
    at = defaultdict(list)
    for r in rows:
        at[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in at.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(at)


def first_fit_decreasing(sizes, capacity):
    gaps = []
    for s in sorted(sizes, reverse=True):
        i = next((i for i, g in enumerate(gaps) if g >= s), None)
        if i is None:
            gaps.append(capacity - s)
        else:
            gaps[i] -= s
    return len(gaps)


DOCS = [
    (1, "one two three"), (2, None), (3, ""), (4, "word " * 3000), (5, "one two three"), (5, "one two three"),
    (None, "no id"), (6, "a b  c\n\n  d \t\r\n e\x1cf <|endoftext|> g 'll don't  "), (7, "  \n x" * 50), (8, "éèß漢字 " * 40),
]


def test_pieces_and_places(spark):
    df = spark.createDataFrame(DOCS, "doc_id long, text string").selectExpr("*", "0 AS length", "'x' AS item")
    rows = packing.packed(df, PATH, 64, 2).collect()
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows} == brute(DOCS, 64, 2)
    assert len(rows) == sum(1 for _ in rows) and sum(r.doc_id == 5 for r in rows) == 2
    gapless(rows, 64)
    placed = packing.packed(df, PATH, 64, 2)
    joined = {r.sequence_id: bytes(r.ids) for r in packing.sequences(placed).collect()}
    for r in placed.collect():
        assert joined[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids)


def test_no_rows(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert packing.packed(df, PATH, 64, 2).count() == 0


@pytest.mark.parametrize("seed", range(8))
def test_plan_is_whole_and_tight(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.integers(20, 200))
    sizes = rng.integers(1, capacity + 1, int(rng.integers(1, 400)))
    if seed % 2:
        sizes = np.maximum(1, sizes // 6)
    counts = dict(zip(*(x.tolist() for x in np.unique(sizes, return_counts=True))))
    kinds = packing.plan(counts, capacity)
    used = defaultdict(int)
    for n, held in kinds:
        assert n > 0 and sum(s * t for s, t in held) <= capacity
        assert sum(t for s, t in held if 3 * s > capacity) <= 2
        for s, t in held:
            used[s] += n * t
    assert used == counts
    assert sum(n for n, _ in kinds) <= first_fit_decreasing(sizes, capacity) + 1


def test_hot_length(spark):
    df = spark.range(5000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'same text here', concat('t', id)) AS text")
    rows = packing.packed(df, PATH, 16, 2, keep_ids=False).collect()
    assert len(rows) == 5000
    n = gapless(rows, 16)
    assert n <= first_fit_decreasing([r.length for r in rows], 16)
