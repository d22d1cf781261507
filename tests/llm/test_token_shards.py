import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from caseloom.llm import token_shards as S
from caseloom.llm.tokens import Encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
ROWS = [(5, "hello world"), (3, None), (9, ""), (1, "a  b\n\n c\x1cd   e "), (12, "long text " * 4000), (5, "hello again"), (5, "hello world"), (None, "no key")]


def brute(rows):
    tok, start, out = Tokenizer.from_file(PATH), 0, []
    key = lambda r: (r[0] is not None, r[0] or 0)
    for doc_id, text in sorted(rows, key=key):
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_encoder_is_the_library():
    tok, enc = Tokenizer.from_file(PATH), Encoder(PATH)
    texts = ["", "a", " a", "a ", "  a  b ", "x\n\n  y", "don't  'll 12 3!?\t\tz", "é漢字  ß", "<|endoftext|> x", "a  b", "a\x85  b", "😀 😀x", "á b", " \n "] * 2
    for t, raw in zip(texts, enc.encode(texts)):
        assert np.frombuffer(raw, enc.dtype).tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)


def test_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "SHARD_IDS", 40)
    rows = [*ROWS, *((i, f"text number {i} " * (i % 7)) for i in range(20, 90))]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0 AS shard", "1 AS n")
    manifest = S.write_shards(df, str(tmp_path), PATH, shards=4)
    got = S.read_documents(df, manifest, keep_ids=True).collect()
    want = brute([r for r in rows if r[0] != 5])
    plain = [r for r in got if r.doc_id != 5]
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in plain) == sorted((str(a), n, c) for a, _, n, c in want)
    assert sum(r.doc_id == 5 for r in got) == 3
    # starts follow one another in ascending order of keys
    end = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == end
        end += r.n_tokens
    keys = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert keys[0] is None and keys[1:] == sorted(keys[1:])
    for r in got:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32


def test_unknown_keys_and_no_rows(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    manifest = S.write_shards(df, str(tmp_path), PATH, shards=2)
    other = spark.createDataFrame([(4, ""), (100, ""), (3, "")], "doc_id long, text string")
    assert [r.doc_id for r in S.read_documents(other, manifest).collect()] == [3]
    assert S.round_trip(df.limit(0), PATH).count() == 0


def test_perfect_hash():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 1 << 62, 20000)).astype(np.uint64)
    h = S.PerfectHash.build(keys)
    assert sorted(h.slots(keys).tolist()) == list(range(len(keys)))
    again, used = S.PerfectHash.from_bytes(h.to_bytes(), len(h.levels))
    assert (again.slots(keys) == h.slots(keys)).all() and used == len(h.to_bytes())
    assert 8 * used < 4.5 * len(keys)
