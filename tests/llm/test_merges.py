import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from caseloom.llm import merges as M

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", " ", "a  b   c ", "\n\t x\r\n y", "é ñ 漢字😀", "x" * 300, "hello transformation world", "    " * 20 + "z", "\x00\x01 1.5%", "naïve unbelievable", " lead", "trail "]


@pytest.fixture(scope="module")
def plain():
    return M.Segmenter(MODEL, 0.0, 0, 1)


def ids(raw):
    return np.frombuffer(raw, "<i4").tolist()


def test_rate_zero_is_the_library(plain):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = [*TEXTS, "antidisestablishmentarianism " * 9, "q" * 63 + " " + "ab" * 40]
    assert [ids(x) for x in plain.encode(list(range(len(texts))), texts)] == library.encode(texts)


@pytest.mark.parametrize("rate", [0.05, 0.3, 1.0])
def test_dropout_decodes_to_the_text(plain, rate):
    texts = [*TEXTS, "▁a ▁▁b", "word " * 500]
    s = M.Segmenter(MODEL, rate, 3, 4)
    made = s.encode(list(range(len(texts))), texts)
    assert [s.decode(x) for x in made] == texts
    again = M.Segmenter(MODEL, rate, 3, 4).encode(list(range(len(texts))), texts)
    assert made == again
    if rate == 1.0:  # no merge is left
        assert all(len(plain.merges.plain[i]) == 1 or plain.merges.plain[i].decode().isprintable() and len(plain.merges.plain[i].decode()) == 1 for x in made for i in ids(x))


def test_segmentations_vary():
    s = M.Segmenter(MODEL, 0.3, 1, 16)
    made = {s.encode([k], ["transformation of information"])[0] for k in range(60)}
    assert len(made) > 30
    other = M.Segmenter(MODEL, 0.3, 2, 16)
    assert {other.encode([k], ["transformation of information"])[0] for k in range(60)} != made


def test_in_step_is_the_agenda(plain):
    rng = np.random.default_rng(1)
    letters = list("abcdeinorst é漢")
    words = [" " + "".join(rng.choice(letters, int(rng.integers(1, 40)))) for _ in range(300)]
    keys = rng.integers(0, 1 << 62, len(words)).astype(np.uint64)
    for rate in (0.0, 0.2):
        sym, bounds = plain.merges.in_step(words, keys, rate)
        step = [sym[a:b] for a, b in zip(bounds, bounds[1:])]
        assert len(step) == len(words) and all(a.tolist() == plain.merges.agenda(w, int(k), rate).tolist() for a, w, k in zip(step, words, keys))


def test_tables(spark):
    rows = [(1, "hello  world"), (2, None), (3, ""), (None, "no id"), (1, "hello  world"), (5, "long " * 30_000), (6, "y" * 50_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS pieces", "0 AS decoded")
    made = M.encode(df, MODEL, seed=5)
    back = M.decode(made, MODEL).collect()
    assert sorted((str(r.doc_id), r.decoded) for r in back) == sorted((str(i), t or "") for i, t in rows)
    got = M.round_trip(df, MODEL, seed=5).collect()
    assert len(got) == len(rows) and all(r.lossless for r in got)
    assert {r.ids_crc32 for r in got} == {zlib.crc32(r.pieces) for r in back}
    assert M.round_trip(df.limit(0), MODEL).count() == 0
