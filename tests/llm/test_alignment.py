"""Alignment of two tokenizers against plain Python."""

import hashlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from caseloom.llm import alignment as A
from caseloom.llm.queries import QUERIES

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "hello transformation world", "", None, " ", "a  b   c ", "\n\t x\r\n y", "é ñ 漢字😀 naïve", "x" * 5000, "ÿ" * 3000, "▁a b", "a <|endoftext|> b </s> <0x41> <s>",
    "hello transformation world", "hello hello hello", "word " * 3000, "\x00\x01 1.5%", "The THE the.", " lead", "    " * 200 + "z", "﷽ ǅ İ",
]


def plain(rows):
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    byte = A._byte_of_char()
    made, held = [], Counter()
    for _, text in rows:
        links, groups, na, nb = Counter(), [], 0, 0
        if text:
            whole = (" " + text).encode()
            ids = [a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)]
            words = [[bytes(byte[c] for c in a.id_to_token(i)) for i in ids[0]]]
            words.append([bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b.id_to_piece(i)) for i in ids[1])])
            if all(b"".join(w) == whole for w in words):
                na, nb = map(len, ids)
                ends = []
                for w in words:
                    at, side = 0, []
                    for x in w:
                        at += len(x)
                        side.append(at)
                    ends.append(side)
                cuts = sorted(set(ends[0]) & set(ends[1]))
                at = [0, 0]
                for cut in cuts:
                    group = []
                    for k in (0, 1):
                        own = []
                        while at[k] < len(ends[k]) and ends[k][at[k]] <= cut:
                            own.append(ids[k][at[k]])
                            at[k] += 1
                        group.append(own)
                    groups.append(group)
                    left, right = Counter(group[0]), Counter(group[1])
                    for x in left:
                        for y in right:
                            links[x, y] += left[x] * right[y]
        held.update(links.keys())
        made.append((na, nb, groups, links))
    top = defaultdict(int)
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    out = []
    for (doc_id, _), (na, nb, groups, links) in zip(rows, made):
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        best = sum(n for p, n in links.items() if held[p] == top[p[0]])
        total = sum(n * held[p] for p, n in links.items())
        digest = hashlib.sha256(shown.encode()).hexdigest() if na else ""
        out.append((doc_id, na, nb, len(groups), sum(links.values()), best, total, digest))
    return out


def by_id(rows):
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("hot", [A.HOT, 8])
def test_against_plain_python(spark, monkeypatch, hot):
    monkeypatch.setattr(A, "HOT", hot)  # 8: nearly all pairs go through the shuffle
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "hello transformation world"), (None, "no id, hello world")]
    df = spark.createDataFrame(rows, "doc_id int, text string").selectExpr("*", "'x' AS pairs", "1 AS row", "2 AS n_a")
    got = A.alignment(df.repartition(3), *PATHS)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert dict(got.dtypes)["doc_id"] == "bigint"
    assert by_id(got.collect()) == by_id(plain(rows))


def test_wide_groups_count_like_others(monkeypatch):
    texts = ["ÿ" * 50, "漢字 and ∑ unaligned 漢" * 9, "hello world"]
    whole = A.align(texts, A.aligner(*PATHS))
    monkeypatch.setattr(A, "WIDE", 0)
    apart = A.align(texts, A.aligner(*PATHS))
    for x, y in zip(whole[:5], apart[:5]):
        assert x.equals(y)
    pairs = [[sorted(zip(p, t)) for p, t in zip(m[5].to_pylist(), m[6].to_pylist())] for m in (whole, apart)]
    assert pairs[0] == pairs[1] and any(pairs[0])


def test_partial_counts(spark, monkeypatch):
    monkeypatch.setattr(A, "PARTIAL_ROWS", 4)
    rows = spark.createDataFrame([([1, 2, 3],), ([1, 2],), ([1],), ([],), ([7, 8, 9, 10, 11],), ([7],)], "pairs array<long>")
    got = {r.pair: (r.n, r.best) for r in A.pair_counts(rows, 4).collect()}
    assert got == {1: (3, True), 2: (2, False), 3: (1, False), 7: (2, True), 8: (1, True), 9: (1, True), 10: (1, True), 11: (1, True)}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert A.alignment(df, *PATHS).collect() == []


def test_query_against_plain_python(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert by_id(QUERIES["op12_token_alignment"](spark, sf).collect()) == by_id(plain(rows))


def test_pieces_come_without_an_object_for_each_id(monkeypatch):
    """Ids of the second tokenizer are read as arrays, and are the library's; empty texts have none."""
    both = A.aligner(*PATHS)
    texts = ["one two", "", "ünï ▁ \t 3", "x" * 3000]
    want = [both.b.encode(t) for t in texts]
    monkeypatch.setattr(both, "b", SimpleNamespace(encode_as_numpy=both.b.encode_as_numpy))
    assert both.encode_b(texts).to_pylist() == want
    assert both.encode_b([""]).to_pylist() == [[]] and both.encode_b([]).to_pylist() == []
