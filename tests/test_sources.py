import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom import schemas
from caseloom.operators import classify as C
from caseloom.config import TriageConfig
from caseloom.plans import evaluation, preparation, triage
from caseloom.sources import readers, writers

HEADER = "tweet_id,author_id,inbound,created_at,text,response_tweet_id,in_response_to_tweet_id\n"


def test_csv_with_quotes_and_line_breaks(spark, tmp_path):
    f = tmp_path / "t.csv"
    f.write_text(HEADER + '1,100,True,Tue Oct 31 22:10:47 +0000 2017,"say ""hi""\nthere",,\n2,acme,False,,"",3,1.0\n', encoding="utf-8")
    got = readers.read_csv(spark, str(f)).orderBy("tweet_id").collect()
    assert got[0]["text"] == 'say "hi"\nthere' and got[0]["in_response_to_tweet_id"] is None
    assert got[1]["text"] is None
    assert readers.read_csv(spark, str(f), keep_empty=True).where("tweet_id = 2").first()["text"] == ""


def test_latin1_fallback(spark, tmp_path):
    (tmp_path / "l.csv").write_bytes((HEADER + "1,a,True,,caf\xe9,,\n").encode("latin-1"))
    (tmp_path / "u.csv").write_bytes((HEADER + "1,a,True,,caf\xe9,,\n").encode("utf-8"))
    for name in ("l.csv", "u.csv"):
        assert readers.read_csv_any_encoding(spark, str(tmp_path / name)).first()["text"] == "caf\xe9"


def test_replacement_character_in_utf8(spark, tmp_path):
    (tmp_path / "u.csv").write_text(HEADER + "1,a,True,,caf\u00e9 \ufffd,,\n", encoding="utf-8")
    (tmp_path / "l.csv").write_bytes((HEADER + "2,a,True,,caf\xe9,,\n").encode("latin-1"))
    got = readers.read_csv_any_encoding(spark, str(tmp_path)).collect()
    assert {r["tweet_id"]: r["text"] for r in got} == {1: "caf\u00e9 \ufffd", 2: "caf\u00e9"}


def test_spaces_survive_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, " \t "), (2, " x ")], "n long, s string")
    assert sorted(map(tuple, readers.read_csv(spark, writers.write_csv(df, str(tmp_path / "s")), df.schema).collect())) == [(1, " \t "), (2, " x ")]


def _whole(spark, path, schema):
    """Spark's own reader, one task a file."""
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path)


@pytest.mark.parametrize("size", [500, 1000, 1 << 20])
def test_ranges_of_any_size_give_the_same_rows(spark, tmp_path, size):
    """Texts with quotes and line ends, one longer than many ranges, cut everywhere."""
    texts = ["plain", 'say "hi"', "two\nlines", '"\n"', "", None, "a,b\n,c", "\n\n\n", '""', "x" * 300 + '\n"' + "y\n" * 100, " s ", "caf\u00e9 \u6f22"]
    rows = [(i, texts[i % len(texts)], texts[(5 * i + 3) % len(texts)]) for i in range(400)]
    df = spark.createDataFrame(rows, "n long, s string, t string")
    path = writers.write_csv(df.coalesce(2), str(tmp_path / "s"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes") if spark.conf.get(k, None)}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        got = readers.read_csv(spark, path, df.schema)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, _whole(spark, path, df.schema).collect()), key=str)
        assert got.count() == 400
        blocks = readers.csv_records(spark, path).select("file", "block").distinct().count()
        assert blocks > (10 if size <= 1000 else 1)
    finally:
        for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
            spark.conf.set(k, before[k]) if k in before else spark.conf.unset(k)


def test_line_ends_of_two_characters(spark, tmp_path):
    (tmp_path / "w.csv").write_bytes(b'n,s\r\n1,"a\r\nb"\r\n2,c\r\n\r\n3,')
    got = readers.read_csv(spark, str(tmp_path / "w.csv"), T.StructType().add("n", "long").add("s", "string"))
    assert sorted(map(tuple, got.collect())) == [(1, "a\r\nb"), (2, "c"), (3, None)]


def test_header_only_and_empty_files(spark, tmp_path):
    (tmp_path / "h.csv").write_text(HEADER)
    (tmp_path / "e.csv").write_text("")
    assert readers.read_csv(spark, str(tmp_path)).collect() == []


def test_largest_file(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "b" / "big.csv").write_text("x" * 100)
    (tmp_path / "small.csv").write_text("x")
    (tmp_path / "huge.txt").write_text("x" * 1000)
    assert readers.largest_file(spark, str(tmp_path)).endswith("big.csv")


@pytest.mark.parametrize(
    "doc, want",
    [
        (["one", {"message": "two"}, {"customer_message": "three"}, {"message": "", "customer_message": "four"}, {}], ["one", "two", "three", "four", ""]),
        ({"description": "d", "samples": [{"id": "S1", "message": "m"}]}, ["m"]),
    ],
)
def test_sample_messages(spark, tmp_path, doc, want):
    f = tmp_path / "s.json"
    f.write_text(json.dumps(doc, indent=1))
    got = readers.read_sample_messages(spark, str(f)).orderBy("position").collect()
    assert [r["message"] for r in got] == want


def test_json_elements_of_cut_documents(spark, tmp_path):
    """Documents with every awkward string, compact and indented, read in ranges of a few bytes."""
    hard = ['a, "b"', "[", "]}", "\\", '\\"', "line\nend", "", ",", '{"samples": [1]}', "é\U0001f600,"]
    lists = [
        hard,
        [],
        [[]],
        [[1, [2, 3]], {"a": [1, 2], "b": "],"}, None, 1.5, True],
        [{"message": m, "n": [i, {"k": hard}]} for i, m in enumerate(hard)],
    ]
    docs = {}
    for i, items in enumerate(lists):
        docs[f"list{i}"] = (items, items)
        docs[f"object{i}"] = ({"about": {"x": [1, 2], "samples": [9]}, "notes": [{"samples": [8, 8]}, "a,b"], "samples": items, "z": [1, {}]}, items)
        docs[f"first{i}"] = ({"samples": items}, items)
    docs |= {"none": ({"other": [1, 2]}, []), "single": ({"samples": {"a": [1, 2]}}, []), "text": ("a, b", []), "number": (7, [])}
    folder = tmp_path / "docs"
    folder.mkdir()
    for name, (doc, _) in docs.items():
        (folder / f"{name}-c.json").write_text(json.dumps(doc, ensure_ascii=False, separators=(",", ":")), "utf-8")
        (folder / f"{name}-i.json").write_text("\n " + json.dumps(doc, indent=2) + "\n", "utf-8")
    for name, bad in {"open": "[1, 2", "string": '["a, 2]', "gap": "[1,,2]", "after": "[1, 2] 3", "word": "[1, x]", "two": "[1], [2]"}.items():
        (folder / f"bad-{name}.json").write_text(bad)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("149", "1000000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            rows = readers.json_elements(spark, str(folder)).select("file", "position", F.to_json("item").alias("item")).collect()
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        got = {}
        for r in sorted(rows, key=lambda r: (r["file"], r["position"])):
            got.setdefault(r["file"].rsplit("/", 1)[1][:-5], []).append((r["position"], json.loads(r["item"])))
        want = {f"{name}-{form}": list(enumerate(items)) for name, (_, items) in docs.items() for form in "ci" if items}
        assert got == want


def test_fields(spark, tmp_path):
    f = tmp_path / "s.txt"
    f.write_text("Selected brand: acme\nReason: a: b\n")
    assert readers.read_field(spark, str(f), "Selected brand") == "acme"
    assert readers.read_field(spark, str(f), "Reason") == "a: b"
    assert readers.read_field(spark, str(f), "None") is None


def test_selected_brand(spark, tmp_path):
    (tmp_path / "s.txt").write_text("Selected brand: acme\nTweets: 3\n")
    assert readers.selected_brand(spark, str(tmp_path / "s.txt")) == "acme"
    rows = spark.createDataFrame([("a: b", 3)], "selected_brand string, tweets int")
    assert readers.selected_brand(spark, writers.write_summary(rows, str(tmp_path / "j"))) == "a: b"


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "i int, s string")
    back = readers.read_csv(spark, writers.write_csv(df, str(tmp_path / "c")), df.schema)
    assert back.count() == 2
    a, b = writers.write_twice(df, str(tmp_path / "x"), str(tmp_path / "y"))
    assert spark.read.parquet(a).exceptAll(spark.read.parquet(b)).count() == 0
    path = writers.write_json(df, str(tmp_path / "j"))
    assert '"s":null' in "".join(r["value"] for r in spark.read.text(path).collect())
    assert readers.read_report(spark, writers.write_summary(df.where("i = 1"), str(tmp_path / "r")), df.schema).first()["s"] == "a"
    assert readers.read_table(spark, str(tmp_path / "none")) is None
    assert readers.read_table(spark, a, ["missing"]) is None


@pytest.fixture(scope="module")
def tweets(spark):
    kinds = F.array(*[F.lit(x) for x in ("refund my money please", "premium plan question", "cannot log in here", "music will not play", "hello friends today")])
    asked = spark.range(300).select(
        (F.col("id") * 2).alias("tweet_id"),
        F.col("id").cast("string").alias("author_id"),
        F.lit(True).alias("inbound"),
        F.lit("Tue Oct 31 22:10:47 +0000 2017").alias("created_at"),
        F.concat(F.get(kinds, (F.col("id") % 5).cast("int")), F.lit(" no "), (F.col("id") + 10).cast("string")).alias("text"),
        F.lit(None).cast("string").alias("response_tweet_id"),
        F.lit(None).cast("long").alias("in_response_to_tweet_id"),
    )
    answered = asked.select(
        (F.col("tweet_id") + 1).alias("tweet_id"),
        F.lit("acme").alias("author_id"),
        F.lit(False).alias("inbound"),
        "created_at",
        F.concat(F.lit("about: "), "text").alias("text"),
        "response_tweet_id",
        F.col("tweet_id").alias("in_response_to_tweet_id"),
    )
    return asked.unionByName(answered)


@pytest.fixture(scope="module")
def prepared(spark, tweets, tmp_path_factory):
    return preparation.prepare(spark, tweets, str(tmp_path_factory.mktemp("prep")), low=100, high=1000, per_label=8)


def test_preparation(spark, prepared):
    assert spark.read.parquet(prepared["support_cases"]).count() == 300
    assert spark.read.parquet(prepared["golden_set"]).count() == 40
    splits = spark.read.parquet(prepared["splits"])
    assert {r["split"] for r in splits.select("split").distinct().collect()} == {"train", "validation"}
    assert splits.count() == 260
    assert readers.read_report(spark, prepared["selected_brand_summary"], T.StructType().add("selected_brand", "string")).first()["selected_brand"] == "acme"


def test_classifier_beats_majority(spark, prepared, tmp_path):
    gold = spark.read.parquet(prepared["golden_set"])
    train = spark.read.parquet(prepared["splits"]).where("split = 'train'")
    cfg = TriageConfig(max_iter=30)
    model = writers.load_or_fit_classifier(spark, str(tmp_path / "m"), train, cfg)
    again = writers.load_or_fit_classifier(spark, str(tmp_path / "m"), None, cfg)
    table = {r["model"]: r for r in evaluation.compare_baselines(train, gold, again).collect()}
    assert table[evaluation.TFIDF]["accuracy"] > 0.9 > table[evaluation.MAJORITY]["accuracy"]
    got = C.classify(gold, model, "customer_message").select("classification").collect()
    for (c,) in got:
        p = [t["probability"] for t in c["top_intents"]]
        assert p == sorted(p, reverse=True) and sum(p) == pytest.approx(1, abs=1e-3)
        assert c["intent"] == c["top_intents"][0]["intent"] and c["confidence"] == p[0]


def test_sample_triage(spark, prepared, tmp_path):
    from caseloom.operators.similarity import build_index
    from caseloom.session import store
    from test_triage import always

    f = tmp_path / "in.json"
    f.write_text(json.dumps({"samples": [{"message": "refund my money please"}, {"message": ""}]}))
    index = build_index(spark.read.parquet(prepared["support_cases"]), keep=store)
    out = triage.triage_samples(spark, str(f), str(tmp_path / "out"), always, index)
    got = spark.read.json(out).orderBy("position").collect()
    assert [r["decision"] for r in got] == ["AUTO_HANDLE", "ESCALATE"]


def test_schema_has_long_links():
    assert schemas.TWEETS["in_response_to_tweet_id"].dataType.simpleString() == "bigint"
