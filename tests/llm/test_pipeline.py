"""The pipeline against plain Python on a small table."""

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from test_packing import brute as brute_pieces
from test_packing import gapless
from test_simhash import brute as brute_groups
from test_simhash import plain_print
from test_substring import brute as brute_repeats

import corpus_pipeline as C
from caseloom.llm import language, toxicity
from caseloom.llm.grams import crc_of_id
from caseloom.session import store

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    """The given documents, some near copies, and rows with nulls, blanks and repeats."""
    given = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in given]
    long = [r for r in rows if r[4] > 1500][:4]
    rows += [(1000 + i, r[1], r[2], "copy", r[4]) for i, r in enumerate(long)]
    rows += [(1100 + i, r[1] + " tail", r[2], None, None) for i, r in enumerate(long)]
    rows += [(1200, "begin " + " ".join(long[0][1].split()[5:120]), "en", "part", 1), (1300, None, "en", "x", 0), (1301, "", None, "x", 0), (1302, "12 %%", "en", "x", 5)]
    rows += [rows[3], rows[3], (None, long[1][1], "en", "x", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def as_rows(df):
    return [tuple(r) for r in df.collect()]


def test_stages(spark, docs):
    columns = docs.columns
    model = language.fit(docs.where(crc_of_id(docs.doc_id) % 3 != 1))
    z = np.unpackbits(model.landmarks, axis=1, count=1 << language.BITS).astype(np.float32)
    assert len(z) and model.names == ["de", "en", "es", "fr"]
    told = store(C.language_id(spark, docs, SF))
    key = lambda r: tuple((x is not None, str(x)) for x in r)
    assert told.columns == columns
    assert sorted(as_rows(told), key=key) == sorted([r for r in as_rows(docs) if language.has_letter(r[1])], key=key)

    clean = store(C.without_toxic(spark, told, SF))
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    tox = toxicity.fit(told, labels.where(crc_of_id(labels.doc_id) % 4 != 2))
    find = toxicity._Known(tox.features)
    mild = [r for r in as_rows(told) if tox.weights[find.of(r[1])].sum() + tox.bias < np.log(0.3 / 0.7)]
    assert clean.columns == columns and sorted(as_rows(clean), key=key) == sorted(mild, key=key)

    firsts = store(C.one_of_near_copies(spark, clean, SF))
    got, rows = as_rows(firsts), as_rows(clean)
    ids = [r[0] if r[0] is not None else 1 << 40 for r in rows]
    groups = brute_groups([plain_print(r[1], 4) for r in rows], ids, 4)
    want = {r for r, i, g in zip(rows, ids, groups) if i == g}
    assert firsts.columns == columns and sorted(got, key=key) == sorted(want, key=key) and len(got) < len(rows) - 5

    left = store(C.without_repeats(spark, firsts, SF))
    rows = as_rows(firsts)
    assert len(rows) == len(got)
    want = {(i, n - gone) for i, n, gone, _ in brute_repeats([(r[0], r[1]) for r in rows], 50) if gone < n or not n}
    got = as_rows(left)
    assert left.columns == columns and {(str(r[0]), len(r[1].split())) for r in got} == want
    before = {r[0]: r for r in rows}
    assert all(r == before[r[0]] or r[4] == len(r[1]) and r[2:4] == before[r[0]][2:4] for r in got)
    assert any(r != before[r[0]] for r in got)

    packed = C.packed_sequences(spark, left, SF).collect()
    pieces = {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed}
    assert pieces == brute_pieces([(r[0], r[1]) for r in got], 1024, 2) and len(packed) == len(pieces)
    assert gapless(packed, 1024) <= sum(r.length for r in packed) / 1024 * 1.02 + 1


def test_run(spark):
    got = C.run(spark, SF)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert gapless(got.collect(), 1024) > 1
    assert len(C.STAGES) == 5 and C.ORACLE_SQL is None and public_tokenizers.path("byte_bpe_50k.json")


def test_no_documents(spark, docs):
    df = docs.limit(0)
    for _, stage in C.STAGES:
        df = store(stage(spark, df, SF))
        assert df.count() == 0


def test_stages_keep_columns_of_any_name(spark, docs):
    """Columns called like something that a stage makes come out as they went in."""
    clash = ["row", "score", "lang_pred", "lang_score", "_toxic", "toxic_pred", "toxic_score", "predicted", "set_id", "bucket", "rest", "fp", "Row"]
    df = docs.where("doc_id < 60 OR doc_id >= 1000")
    for i, c in enumerate(clash[:-1]):
        df = df.withColumn(c, df.doc_id * 100 + i)
    for _, stage in C.STAGES[:-1]:
        df = store(stage(spark, df, SF))
        rows = df.collect()
        assert df.columns == docs.columns + clash[:-1] and rows
        assert all(r[c] == r.doc_id * 100 + i for r in rows if r.doc_id is not None for i, c in enumerate(clash[:-1]))


def test_rows_that_share_an_id(spark):
    """Rows of one id that are no copies stay, of equal rows one, and a row without an id is a copy like any other."""
    a, b, c = (" ".join(f"{w}{i}" for i in range(30)) for w in "abc")
    rows = [(1, a, "x"), (1, b, "x"), (1, a, "x"), (1, a, None), (2, a, "y"), (None, c, "y"), (None, c, "z"), (None, b, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = as_rows(C.one_of_near_copies(spark, df, SF))
    assert sorted(r[1] for r in got) == [a, b, c] and [r[0] for r in sorted(got, key=lambda r: r[1])] == [1, 1, None]
    assert sorted(map(str, as_rows(C.one_of_near_copies(spark, df.repartition(3), SF)))) == sorted(map(str, got))
