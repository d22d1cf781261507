"""The fitted classifier and the streaming forms."""

from uuid import uuid4

from pyspark.sql import functions as F

from caseloom import config
from caseloom.config import TriageConfig
from caseloom.operators import classify as C
from caseloom.operators import golden as G
from caseloom.operators import similarity
from caseloom.plans import evaluation, triage
from caseloom.plans.catalogue import bindings as B
from caseloom.plans.catalogue import query
from caseloom.plans.catalogue.answering import CHECK, NAMES, RESULT, _classes, triage_sql
from caseloom.plans.catalogue.similar import _index, searches
from caseloom.session import shared_folder, store
from caseloom.sources import writers
from caseloom.streaming import live

CFG = TriageConfig()


def _fitted(spark, sf):
    gold = store(G.golden_set(B.pool(spark, sf), B.PER_LABEL, B.SEED))
    train = G.make_splits(B.pool(spark, sf), gold, seed=B.SEED).where("split = 'train'")
    return C.fit_classifier(train, CFG, B.STOPS), train, gold


@query(
    "M6_classifier_report",
    B.with_views(
        "splits",
        """SELECT g.intent AS label, count(*) AS examples, TRUE AS scored, TRUE AS beats_majority
        FROM golden g GROUP BY 1""",
    ),
)
def fitted_report(spark, sf):
    """Per golden label its examples, whether its figures lie between 0 and 1, and whether the model beats the majority."""
    model, train, gold = _fitted(spark, sf)
    results = evaluation.tfidf_results(model, gold)
    report = results["report"]
    base = evaluation.majority_report(train, gold)
    better = [r.where("metric = 'accuracy'").select("value").scalar() for r in (report, base)]
    fine = report.where("metric LIKE 'per_intent_%'").groupBy("label").agg(
        (F.count_if(F.col("value").between(0, 1)) == 3).alias("scored")
    )
    sizes = results["predictions"].groupBy(F.col("true_intent").alias("label")).agg(F.count(F.lit(1)).alias("examples"))
    return sizes.join(fine, "label").withColumn("beats_majority", better[0] > better[1])


@query(
    "M7_batch_predictions",
    B.with_views("splits inbox", "SELECT message_id, TRUE AS known_label, TRUE AS sums_to_one, TRUE AS surest_first FROM inbox"),
)
def batch_predictions(spark, sf):
    """For every message, whether its classes are the training labels with falling probabilities that sum to one."""
    model, train, _ = _fitted(spark, sf)
    rows = C.classify(B.inbox(spark, sf), model)
    top = F.col("classification.top_intents")
    names = F.array(*[F.lit(x) for x in C.labels_of(model)])
    total = F.aggregate(top, F.lit(0.0), lambda a, t: a + t["probability"])
    falling = F.forall(F.sequence(F.lit(1), F.size(top) - 1), lambda i: F.get(top, i - 1)["probability"] >= F.get(top, i)["probability"])
    return rows.select(
        "message_id",
        F.array_contains(names, F.col("classification.intent")).alias("known_label"),
        (F.abs(total - 1) < 0.01).alias("sums_to_one"),
        (falling & (F.get(top, F.lit(0))["intent"] == F.col("classification.intent"))).alias("surest_first"),
    )


@query(
    "S12_saved_classifier",
    B.with_views("splits inbox", "SELECT message_id, TRUE AS as_fitted FROM inbox"),
)
def saved_classifier(spark, sf):
    """For every message, whether the classifier that was saved and loaded again gives the fitted one's classes."""
    gold = store(G.golden_set(B.pool(spark, sf), B.PER_LABEL, B.SEED))
    train = G.make_splits(B.pool(spark, sf), gold, seed=B.SEED).where("split = 'train'")
    path = f"{shared_folder(spark)}/caseloom/classifier-{uuid4().hex}"
    model = C.fit_classifier(train, CFG, B.STOPS)
    writers.save_classifier(model, path)
    loaded = writers.load_or_fit_classifier(spark, path, None)  # fits nothing, as it is there
    both = C.classify(B.inbox(spark, sf), model).withColumnRenamed("classification", "fitted")
    both = C.classify(both, loaded)
    return both.select("message_id", F.col("fitted").eqNullSafe(F.col("classification")).alias("as_fitted"))


@query(
    "G6_model_triage",
    B.with_views(
        "corpus asked",
        f""", {triage_sql('asked')} SELECT message_id, round(top_similarity, 4) AS top_similarity, CAST(n_results AS BIGINT) AS n_results,
        why = '' AS valid, TRUE AS as_classified, TRUE AS explained FROM grounded""",
        searches("asked"),
    ),
)
def model_triage(spark, sf):
    """Whole-batch triage with the fitted classifier: what was found, and whether the intent is the
    classifier's and low confidence or close classes are among the reasons just where they have to be."""
    splits = store(B.case_splits(spark, sf))
    train = splits.where("split = 'train'")
    model = C.fit_classifier(train, CFG, B.STOPS)
    index = similarity.build_index(train, B.STOPS, keep=store)
    asked = B.asked(spark, sf, splits)
    done = triage.triage(asked, triage.with_model(model), index)
    told = C.classify(asked, model).select("message_id", F.col("classification").alias("own"))
    valid = F.col("intent").isNotNull()
    low = config.REASON_LOW_CONFIDENCE.split("%")[0]
    unsure = F.col("own.confidence") < CFG.confidence_threshold
    named = F.coalesce(F.contains("escalation_reason", F.lit(low)), F.lit(False))
    return done.join(told, "message_id").select(
        "message_id",
        F.col("retrieval.top_similarity").alias("top_similarity"),
        F.col("retrieval.n_results").cast("long").alias("n_results"),
        valid.alias("valid"),
        (~valid | (F.col("intent") == F.col("own.intent"))).alias("as_classified"),
        (~valid | (named == unsure)).alias("explained"),
    )


RANKED = ", ".join(f"ranks[{i + 1}].intent || ' ' || CAST(round(-ranks[{i + 1}].k, 4) AS VARCHAR)" for i in range(len(NAMES)))


@query("W6_ranked_classes", B.with_views("inbox", f", {CHECK}, {_classes('body')} SELECT message_id, concat_ws('; ', {RANKED}) AS ranked FROM classified"))
def ranked_classes(spark, sf):
    rows = B.rule_classifier(B.inbox(spark, sf), "message")
    lines = F.transform("classification.top_intents", lambda t: F.concat_ws(" ", t["intent"], t["probability"].cast("string")))
    return rows.select("message_id", F.array_join(lines, "; ").alias("ranked"))


# --- streams ----------------------------------------------------------------


def _stream(spark, sf, name):
    """A table as a stream, whether it is one file or a folder of them: as a glob (of this one name) Spark takes either."""
    return live.read_stream(spark, f"{sf}/{{{name}.parquet}}", B.table(spark, sf, name).schema, "*")


def _folder(spark, name):
    return f"{shared_folder(spark)}/caseloom/{name}-{uuid4().hex}"


def _drain(spark, frame, name):
    """Run a stream over everything there is now and return what it wrote."""
    folder = _folder(spark, name)

    def put(batch, number):
        batch.write.mode("overwrite").parquet(f"{folder}/out/batch={number}")

    run = frame.writeStream.outputMode("append").option("checkpointLocation", f"{folder}/state").foreachBatch(put)
    run.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out")


@query(
    "X5_windowed_counts",
    """SELECT epoch(time_bucket(INTERVAL 1 DAY, ts))::BIGINT AS window_start, event_type, count(*) AS n FROM events
    GROUP BY 1, 2 HAVING window_start + 86400 <= (SELECT epoch(max(ts)) - 3600 FROM events)""",
)
def windowed(spark, sf):
    """Windows that the watermark has closed; rows that come later are dropped."""
    events = _stream(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    counts = live.windowed_counts(events, "ts", "event_type", "1 day", "1 hour")
    out = _drain(spark, counts, "windowed")
    return out.select(F.unix_seconds("window_start").alias("window_start"), "event_type", "n")


@query(
    "X4_stream_pairs",
    f"""SELECT u.conv_id * {B.SPAN} + u.turn AS customer_tweet_id, a.conv_id * {B.SPAN} + a.turn AS brand_tweet_id,
    CAST(5 + u.conv_id % 7 AS DOUBLE) AS reply_time_minutes
    FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
    WHERE u.role = 'user' AND a.role = 'assistant'""",
)
def stream_pairs(spark, sf):
    seconds = F.col("conv_id") * 3600 + F.col("turn") * (300 + F.col("conv_id") % 7 * 60)

    def side(role):
        return _stream(spark, sf, "conversations").where(F.col("role") == role).select(
            (F.col("conv_id") * B.SPAN + F.col("turn")).alias("tweet_id"),
            (F.col("conv_id") * B.SPAN + F.col("turn") - 1).alias("in_response_to_tweet_id"),
            F.col("conv_id").cast("string").alias("author_id"),
            "text",
            F.timestamp_seconds(seconds + 1_500_000_000).alias("created_at"),
        )

    pairs = live.pair_stream(side("user"), side("assistant"), "7 days", "1 day")
    out = _drain(spark, pairs, "pairs")
    return out.select("customer_tweet_id", "brand_tweet_id", F.round("reply_time_minutes", 6).alias("reply_time_minutes"))


TURNS = {"turns": "SELECT tweet_id AS message_id, text AS message FROM tweets WHERE inbound"}


@query(
    "X3_stream_triage",
    B.with_views(
        "corpus",
        f""", {triage_sql('turns')}, results AS (SELECT {RESULT} FROM grounded)
        SELECT message_id, decision, escalation_reason, reply FROM results""",
        TURNS | searches("turns"),
    ),
)
def stream_triage(spark, sf):
    messages = _stream(spark, sf, "conversations").where("role = 'user'").select(
        (F.col("conv_id") * B.SPAN + F.col("turn")).alias("message_id"), F.col("text").alias("message")
    )
    folder = _folder(spark, "triage")
    index = writers.load_index(spark, writers.save_index(_index(spark, sf), f"{folder}/index"))
    run = live.triage_stream(messages, B.rule_classifier, index, f"{folder}/out", f"{folder}/state")
    run.awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("message_id", "decision", "escalation_reason", "reply")
