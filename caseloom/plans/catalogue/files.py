"""Files: every table is written to the shared folder by a writer and read back by a reader."""

from uuid import uuid4

from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.operators import brands, golden, labels, metrics, profile, similarity
from caseloom.plans import triage
from caseloom.plans.catalogue import bindings as B
from caseloom.plans.catalogue import query
from caseloom.plans.catalogue.answering import RESULT, triage_sql
from caseloom.plans.catalogue.messages import TWEET_COLS
from caseloom.plans.catalogue.scoring import SCALARS
from caseloom.plans.catalogue.similar import QUERIES, looked_up
from caseloom.session import shared_folder, store
from caseloom.sources import readers, segments, writers


def _path(spark, name):
    return f"{shared_folder(spark)}/caseloom/{name}-{uuid4().hex}"


@query("S1_message_scan", B.with_views("tweets", f"SELECT {TWEET_COLS} FROM tweets"))
def message_scan(spark, sf):
    rows = B.tweets(spark, sf)
    return readers.read_csv(spark, writers.write_csv(rows, _path(spark, "tweets")), rows.schema)


@query(
    "S4_keep_empty_strings",
    B.with_views("messy", "SELECT tweet_id, coalesce(text, '') AS text, coalesce(created_at, '') AS created_at FROM messy"),
)
def keep_empty(spark, sf):
    rows = B.messy(spark, sf).select("tweet_id", "text", "created_at")
    return readers.read_csv(spark, writers.write_csv(rows, _path(spark, "messy")), rows.schema, keep_empty=True)


@query("S2_latin1_scan", B.with_views("tweets", "SELECT tweet_id, text FROM tweets"))
def latin1(spark, sf):
    """Some files are UTF-8 and some Latin-1."""
    rows, path = B.tweets(spark, sf).select("tweet_id", "text"), _path(spark, "encodings")
    odd = F.col("tweet_id") % 2 == 1
    writers.write_csv(rows.where(odd), f"{path}/a")
    plain = rows.where(~odd).write.option("header", True).option("escape", '"').option("encoding", "ISO-8859-1")
    plain.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{path}/b")
    return readers.read_csv_any_encoding(spark, f"{path}/*", rows.schema)


@query(
    "S3_files_by_size",
    """SELECT CAST(row_number() OVER (ORDER BY bytes DESC, lang) AS INTEGER) AS place, lang
    FROM (SELECT lang, sum(strlen(text)) AS bytes FROM documents GROUP BY lang) d""",
)
def files_by_size(spark, sf):
    """One folder per language; the languages by what their files hold."""
    path = _path(spark, "by_language")
    B.table(spark, sf, "documents").select("lang", "text").write.partitionBy("lang").json(path)
    files = readers.find_files(spark, path, "*.json")
    sizes = files.groupBy(F.regexp_extract("path", "/lang=([^/]+)/", 1).alias("lang")).agg(F.sum("length").alias("bytes"))
    rank = F.expr("row_number() OVER (PARTITION BY 1 ORDER BY bytes DESC, lang)")
    return sizes.select(rank.alias("place"), "lang")


def _samples(spark, asked):
    """JSON documents of a hundred conversations' messages each."""
    path = _path(spark, "samples")
    item = F.struct(F.col("message_id").cast("string").alias("id"), "message")
    docs = asked.groupBy(F.floor(F.col("message_id") / (100 * B.SPAN)).alias("k")).agg(
        F.to_json(F.struct(F.lit("messages").alias("description"), F.sort_array(F.collect_list(item)).alias("samples"))).alias("value")
    )
    docs.repartition("k").write.partitionBy("k").text(path)
    return path


@query("S5_sample_files", B.with_views("asked", "SELECT message FROM asked"))
def sample_files(spark, sf):
    _, asked = looked_up(spark, sf)
    return readers.read_sample_messages(spark, _samples(spark, asked)).select("message")


@query(
    "G7_sample_batch",
    B.with_views(
        "corpus asked",
        f""", {triage_sql('asked')}, results AS (SELECT {RESULT} FROM grounded)
        SELECT customer_message, intent, intent_confidence, decision, escalation_reason, reply, generation_status FROM results""",
        QUERIES,
    ),
)
def sample_batch(spark, sf):
    index, asked = looked_up(spark, sf)
    out = triage.triage_samples(spark, _samples(spark, asked), _path(spark, "triaged"), B.rule_classifier, index)
    schema = "customer_message string, intent string, intent_confidence double, decision string, escalation_reason string, reply string, generation_status string"
    return spark.read.schema(schema).json(out)


@query("S6_key_value_lines", "SELECT CAST(doc_id AS VARCHAR) AS key, 'quality: ' || CAST(quality AS VARCHAR) AS value FROM labels")
def key_values(spark, sf):
    path = _path(spark, "lines")
    line = F.concat(F.col("doc_id").cast("string"), F.lit(": quality: "), F.col("quality").cast("string"))
    B.table(spark, sf, "labels").select(line).write.text(path)
    return readers.read_fields(spark, path)


@query(
    "S7_saved_report",
    B.with_views("label_metrics", f", {SCALARS} SELECT {', '.join(f'round({m}, 6) AS {m}' for m in metrics.SCALARS)} FROM overall"),
)
def saved_report(spark, sf):
    overall = metrics.overall_metrics(metrics.label_metrics(metrics.pair_counts(B.scored(spark, sf))))
    path = writers.write_summary(overall.select(*metrics.SCALARS), _path(spark, "report"))
    schema = T.StructType([T.StructField(m, T.DoubleType()) for m in metrics.SCALARS])
    return readers.read_report(spark, path, schema).select(*[F.round(m, 6).alias(m) for m in metrics.SCALARS])


@query(
    "S8_csv_sink",
    B.with_views("labelled", "SELECT case_id, customer_message, brand_reply, intent FROM labelled"),
)
def csv_sink(spark, sf):
    rows = B.labelled(spark, sf).select("case_id", "customer_message", "brand_reply", "intent")
    return readers.read_csv(spark, writers.write_csv(rows, _path(spark, "cases")), rows.schema)


@query("S8_partitioned_sink", B.with_views("labelled", "SELECT case_id, customer_message, intent FROM labelled"))
def partitioned_sink(spark, sf):
    rows = B.labelled(spark, sf).select("case_id", "customer_message", "intent")
    return spark.read.schema(rows.schema).parquet(writers.write_parquet(rows, _path(spark, "by_intent"), ["intent"]))


@query("S9_json_sink", B.with_views("messy", "SELECT tweet_id, author_id, inbound, text, in_response_to_tweet_id FROM messy"))
def json_sink(spark, sf):
    rows = B.messy(spark, sf).select("tweet_id", "author_id", "inbound", "text", "in_response_to_tweet_id")
    return spark.read.schema(rows.schema).json(writers.write_json(rows, _path(spark, "messages")))


@query(
    "S10_brand_summary",
    B.with_views(
        "tweets",
        """SELECT author_id AS selected_brand, 2 * count(*) AS tweets, count(*) AS customer_tweets, count(*) AS brand_replies,
        count(*) AS conversations FROM tweets WHERE NOT inbound GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1""",
    ),
)
def brand_summary(spark, sf):
    choice = brands.select_brand(brands.replies_per_brand(B.tweets(spark, sf)), 1, 1 << 40)
    summary = writers.brand_summary(choice)
    return spark.read.schema(summary.schema).json(writers.write_summary(summary, _path(spark, "summary")))


@query(
    "U1_summarised_brand",
    B.with_views(
        "tweets",
        f""", chosen AS (SELECT author_id AS brand FROM tweets WHERE NOT inbound GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
        SELECT {TWEET_COLS} FROM tweets WHERE author_id = (SELECT brand FROM chosen)
        OR in_response_to_tweet_id IN (SELECT tweet_id FROM tweets WHERE author_id = (SELECT brand FROM chosen))
        OR tweet_id IN (SELECT in_response_to_tweet_id FROM tweets WHERE author_id = (SELECT brand FROM chosen)
                        AND in_response_to_tweet_id IS NOT NULL)""",
    ),
)
def summarised_brand(spark, sf):
    """The messages of the brand that a written summary names: the summary is all that the step reads of the selection."""
    rows = B.tweets(spark, sf)
    chosen = brands.select_brand(brands.replies_per_brand(rows), 1, 1 << 40)
    path = writers.write_summary(writers.brand_summary(chosen), _path(spark, "summary"))
    return brands.brand_subset(rows, readers.selected_brand(spark, path))


@query(
    "S11_written_twice",
    B.with_views("golden", "SELECT t.copy AS copy, example_id, intent, source_case_id FROM golden, (VALUES (1), (2)) t(copy)"),
)
def written_twice(spark, sf):
    gold = golden.golden_set(B.pool(spark, sf), B.PER_LABEL, B.SEED)
    paths = writers.write_twice(gold, _path(spark, "golden"), _path(spark, "golden_evaluation"))
    both = [spark.read.parquet(p).select(F.lit(i + 1).alias("copy"), "example_id", "intent", "source_case_id") for i, p in enumerate(paths)]
    return both[0].unionByName(both[1])


@query(
    "S12_loaded_index",
    B.with_views(
        "corpus asked",
        "SELECT message_id, place, 'CASE_' || CAST(doc_id AS VARCHAR) AS case_id, round(score, 4) AS similarity_score FROM top",
        QUERIES,
    ),
)
def loaded_index(spark, sf):
    """What the loaded index of the training cases finds."""
    splits = B.case_splits(spark, sf)
    path, train = _path(spark, "index"), splits.where("split = 'train'")
    writers.load_or_build_index(spark, path, train, stop_words=B.STOPS)
    index = writers.load_or_build_index(spark, path, None)
    r = similarity.retrieve(B.asked(spark, sf, splits), index)
    r = r.select("message_id", F.posexplode("retrieval.top_cases").alias("p", "c"))
    return r.select("message_id", (F.col("p") + 1).cast("long").alias("place"), "c.case_id", "c.similarity_score")


@query(
    "S12_segmented_index",
    B.with_views(
        "corpus asked",
        "SELECT message_id, place, 'CASE_' || CAST(doc_id AS VARCHAR) AS case_id, round(score, 4) AS similarity_score FROM top",
        QUERIES,
    ),
)
def segmented_index(spark, sf):
    """What an index finds whose cases came in three appends, two of them merged later."""
    splits = store(B.case_splits(spark, sf))
    path, train = _path(spark, "segments"), splits.where("split = 'train'")
    third = F.pmod(F.xxhash64("brand_tweet_id"), F.lit(3))
    names = [segments.append(path, train.where(third == i), B.STOPS) for i in range(3)]
    segments.merge(spark, path, names[:2])
    r = similarity.retrieve(B.asked(spark, sf, splits), segments.open_index(spark, path))
    r = r.select("message_id", F.posexplode("retrieval.top_cases").alias("p", "c"))
    return r.select("message_id", (F.col("p") + 1).cast("long").alias("place"), "c.case_id", "c.similarity_score")


ROLES = (("brand", "author_id"), ("reply", "in_response_to_tweet_id"), ("time", "created_at"))


@query(
    "P11_column_roles",
    B.with_views(
        "tweets",
        " UNION ALL ".join(f"SELECT '{r}' AS role, '{c}' AS column_name, count({c}) AS n_values FROM tweets" for r, c in ROLES),
    ),
)
def roles(spark, sf):
    """The columns that look like a brand, a reply link or a time, and how many values they have."""
    rows = B.tweets(spark, sf)
    found = profile.column_roles(spark, rows)
    counts = rows.agg(*[F.count(c).alias(c) for c in rows.columns]).unpivot([], rows.columns, "column_name", "n_values")
    return found.join(counts, "column_name").select("role", "column_name", "n_values")


@query("M1_rules_from_table", B.with_views("labelled", "SELECT case_id, intent FROM labelled"))
def rules_from_table(spark, sf):
    """The labels of rules that are rows of a table."""
    given = [(i, label, word) for i, (label, words) in enumerate(B.RULES) for word in words]
    rules = spark.createDataFrame(given, "priority int, label string, keyword string")
    return labels.label_by_table(B.paired(spark, sf), rules).select("case_id", "intent")


WORD = "[a-z]{4,}"
WORDS_SQL = f"""words AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '{WORD}')) AS keyword FROM documents)"""


def _word_rules(spark, sf):
    """Every word of the documents as a rule that gives itself; longer ones go first."""
    words = B.table(spark, sf, "documents").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0))).alias("keyword"))
    return words.distinct().select((-F.length("keyword")).alias("priority"), F.col("keyword").alias("label"), "keyword")


@query(
    "M1_vocabulary_rules",
    f"""WITH {WORDS_SQL} SELECT conv_id, turn, coalesce(arg_min(keyword, row(-length(keyword), keyword)), 'other') AS intent
    FROM conversations LEFT JOIN words ON contains(lower(text), keyword) GROUP BY conv_id, turn""",
)
def vocabulary_rules(spark, sf):
    """Messages labelled by as many rules as the documents have words (53,769 on sf0.01)."""
    messages = B.table(spark, sf, "conversations").select("conv_id", "turn", "text")
    return labels.label_by_table(messages, _word_rules(spark, sf), "text").select("conv_id", "turn", "intent")


@query(
    "J9_vocabulary_hits",
    f"""WITH {WORDS_SQL} SELECT keyword, count(*) AS messages FROM conversations JOIN words ON contains(lower(text), keyword)
    GROUP BY keyword""",
)
def vocabulary_hits(spark, sf):
    """How many messages hold each word of the documents, alone or inside another word."""
    messages = B.table(spark, sf, "conversations").select("conv_id", "turn", "text")
    hits = labels.keyword_hits_by_table(messages, _word_rules(spark, sf), "text")
    return hits.groupBy("keyword").agg(F.count(F.lit(1)).alias("messages"))
