import random

import numpy as np
import pytest

from caseloom.llm import language, toxicity

STEMS = {"aa": ["the", "of", "tion", "sh", "wh"], "bb": ["der", "ung", "sch", "keit"], "cc": ["eau", "que", "oi", "é"]}


def text(rng, stems, n):
    return " ".join("".join(rng.choice(stems) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(1)
    rows = []
    for i in range(400):
        lang = rng.choice(list(STEMS))
        bad = rng.random() < 0.3
        words = text(rng, STEMS[lang], rng.randrange(5, 60)).split(" ")
        if bad:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["moron", "scum", "idiot"]))
        rows.append((i, " ".join(words), lang, int(bad)))
    return rows


def test_language(spark, corpus):
    df = spark.createDataFrame([r[:3] for r in corpus], "doc_id long, text string, lang string")
    model = language.fit(df.where("doc_id % 2 = 0"), fit_rows=40, landmarks=30)
    assert model.names == sorted(STEMS) and len(model.landmarks) == 30
    rows = [*((i, t, lang) for i, t, lang, _ in corpus), (None, "der ung", None), (901, None, "aa"), (902, "", None), (903, "123 %% __ ²½", "bb"), (904, "que " * 40_000, None), (904, "que", None)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "'x' AS lang_pred", "1 AS score")
    got = language.predict(odd, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r.lang_pred for r in got}
    assert by[901] == by[902] == by[903] == "und" and by[904] == "cc" and by[None] == "bb"
    held = [r for r in corpus if r[0] % 2]
    assert np.mean([by[i] == lang for i, _, lang, _ in held]) > 0.97


def test_language_batches_do_not_matter(spark, corpus):
    model = language.solve([r[1] for r in corpus], [r[2] for r in corpus], 3, 24, 1e-4)
    x = [r[1] for r in corpus[:50]]
    z = np.unpackbits(model.landmarks, axis=1, count=1 << language.BITS).astype(np.float32)
    whole = language.kernel(language.presence(x, 3), z) @ model.weights + model.bias
    one = np.vstack([language.kernel(language.presence([t], 3), z) @ model.weights + model.bias for t in x])
    assert np.allclose(whole, one, atol=1e-4)
    same = language.kernel(language.presence(x, 3), language.presence(x, 3))
    assert np.allclose(np.diag(same), 1) and same.max() < 1.0001


def test_language_without_examples(spark):
    df = spark.createDataFrame([(1, "text", None), (2, None, "aa")], "doc_id long, text string, lang string")
    model = language.fit(df)
    assert [r.lang_pred for r in language.predict(df, model).collect()] == ["und", "und"]
    assert language.predict(df.limit(0), model).count() == 0


def test_toxicity(spark, corpus):
    docs = spark.createDataFrame([(i, t) for i, t, _, _ in corpus], "doc_id long, text string").selectExpr("*", "9 AS toxic", "'x' AS _id")
    labels = spark.createDataFrame([(i, y) for i, _, _, y in corpus if i % 2 == 0] + [(2, None), (4, 7), (99_999, 1), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    rows = [*((i, t) for i, t, _, _ in corpus), (None, "x"), (700, None), (701, ""), (702, "der ung " * 30_000), (702, "moron scum idiot moron")]
    got = toxicity.score(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0 AS score", "0 AS predicted"), model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    by = {r.doc_id: r.predicted for r in got if r.doc_id is not None and r.doc_id < 400}
    held = [r for r in corpus if r[0] % 2]
    assert np.mean([by[i] == y for i, _, _, y in held]) > 0.97
    assert sorted(r.predicted for r in got if r.doc_id == 702) == [0, 1]


def test_toxicity_of_one_class_or_none(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.score(docs, toxicity.fit(docs, empty)).collect()} == {0}
    ones = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.score(docs, toxicity.fit(docs, ones)).collect()} == {1}
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), ones)).count() == 0
