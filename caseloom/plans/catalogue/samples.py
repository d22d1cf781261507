"""Golden set, leakage, splits and review."""

from pyspark.sql import functions as F

from caseloom.functions import text as X
from caseloom.operators import golden as G
from caseloom.operators import labels
from caseloom.plans.catalogue import bindings as B
from caseloom.plans.catalogue import query
from caseloom.session import store

GOLDEN = ", ".join(G.GOLDEN_COLUMNS)
CASE = "customer_tweet_id, case_id, intent"


def _golden(spark, sf):
    return G.golden_set(B.pool(spark, sf), B.PER_LABEL, B.SEED)


def _stored(spark, sf):
    return store(_golden(spark, sf))


@query(
    "W2_stratified_sample",
    B.with_views(
        "pool",
        f"""SELECT {CASE} FROM pool QUALIFY row_number() OVER (PARTITION BY intent
        ORDER BY {B.order_sql('customer_tweet_id', 'brand_tweet_id')}, customer_tweet_id) <= {B.PER_LABEL}""",
    ),
)
def sample(spark, sf):
    return G.stratified_sample(B.pool(spark, sf), B.PER_LABEL, B.SEED).select("customer_tweet_id", "case_id", "intent")


@query("W4_golden_set", B.with_views("golden", f"SELECT {GOLDEN} FROM golden"))
def golden_set(spark, sf):
    return _golden(spark, sf)


@query(
    "P7_templated_columns",
    B.with_views(
        "pool",
        """SELECT case_id AS source_case_id, 'Resolve based on ' || intent AS expected_action, '' AS escalation_reason,
        'keyword_heuristic' AS label_source FROM pool""",
    ),
)
def templated(spark, sf):
    return G.golden_columns(B.pool(spark, sf)).select("source_case_id", "expected_action", "escalation_reason", "label_source")


@query(
    "P8_null_fill",
    B.with_views("messy_pairs", "SELECT customer_tweet_id, coalesce(customer_message, '') AS customer_message, coalesce(brand_reply, '') AS brand_reply, 'other' AS intent FROM messy_pairs"),
)
def null_fill(spark, sf):
    from caseloom.operators.cases import build_cases
    from caseloom.operators.similarity import fill_cases

    rows = build_cases(B.messy(spark, sf)).withColumn("intent", F.lit(None).cast("string"))
    return fill_cases(rows).select("customer_tweet_id", "customer_message", "brand_reply", "intent")


@query(
    "P13_difficulty",
    """SELECT doc_id, CASE WHEN length(text) < 15 OR length(text) > 200 THEN 'difficult' ELSE 'normal' END AS difficulty
    FROM documents""",
)
def difficulty(spark, sf):
    return B.table(spark, sf, "documents").select("doc_id", G.difficulty("text").alias("difficulty"))


@query(
    "P14_review_queue",
    B.with_views("golden", f"SELECT {GOLDEN}, 'pending' AS review_status, '' AS reviewer_notes FROM golden WHERE difficulty = 'difficult'"),
)
def review_queue(spark, sf):
    return G.review_queue(_golden(spark, sf))


@query(
    "A11_golden_quality",
    B.with_views(
        "golden",
        """, q AS (SELECT count(*) AS t, count(*) - count(DISTINCT customer_message) AS d,
             count(*) FILTER (customer_message IS NULL) AS e, count(*) FILTER (difficulty = 'difficult') AS f,
             count(DISTINCT intent) AS i FROM golden)
        SELECT 'total_examples' AS metric, CAST(t AS VARCHAR) AS value FROM q
        UNION ALL SELECT 'duplicate_examples', CAST(d AS VARCHAR) FROM q
        UNION ALL SELECT 'empty_messages', CAST(e AS VARCHAR) FROM q
        UNION ALL SELECT 'difficult_examples', CAST(f AS VARCHAR) FROM q
        UNION ALL SELECT 'number_of_intents', CAST(i AS VARCHAR) FROM q
        UNION ALL SELECT 'label_source', 'keyword_heuristic' FROM q""",
    ),
)
def golden_quality(spark, sf):
    return G.golden_quality(_golden(spark, sf))


@query(
    "W8_spot_check",
    B.with_views(
        "golden",
        f"SELECT {GOLDEN} FROM golden WHERE difficulty = 'normal' ORDER BY {B.order_sql('example_id')}, example_id LIMIT 30",
    ),
)
def spot_check(spark, sf):
    return G.spot_check(_golden(spark, sf), 30, B.SEED)


@query("J4_hold_out", B.with_views("held", f"SELECT {CASE} FROM held"))
def hold_out(spark, sf):
    return G.hold_out(B.pool(spark, sf), _stored(spark, sf)).select("customer_tweet_id", "case_id", "intent")


@query(
    "J5_leaked_messages",
    B.with_views("held", f"SELECT {CASE} FROM held WHERE customer_message IN (SELECT customer_message FROM golden)"),
)
def leaked(spark, sf):
    gold = _stored(spark, sf)
    return G.leaked_messages(G.hold_out(B.pool(spark, sf), gold), gold).select("customer_tweet_id", "case_id", "intent")


@query("J5_clean_pool", B.with_views("clean_pool", f"SELECT {CASE} FROM clean_pool"))
def clean_pool(spark, sf):
    gold = _stored(spark, sf)
    kept = G.without_leaked_messages(G.hold_out(B.pool(spark, sf), gold), gold)
    return kept.select("customer_tweet_id", "case_id", "intent")


@query(
    "J6_leakage_report",
    B.with_views(
        "held",
        """SELECT 'exact_duplicate_messages' AS "check", count(*) AS n FROM held
           WHERE customer_message IN (SELECT customer_message FROM golden)
        UNION ALL SELECT 'conversation_overlap', count(*) FROM held WHERE conversation_id IN
          (SELECT conversation_id FROM pool WHERE case_id IN (SELECT source_case_id FROM golden))""",
    ),
)
def leakage_report(spark, sf):
    return G.leakage_report(B.pool(spark, sf), _stored(spark, sf))


@query("W5_train_validation_split", B.with_views("splits", f"SELECT {CASE}, split FROM splits"))
def splits(spark, sf):
    return G.make_splits(B.pool(spark, sf), _stored(spark, sf), seed=B.SEED).select(
        "customer_tweet_id", "case_id", "intent", "split"
    )


@query(
    "U4_label_set_difference",
    f"""WITH x AS (SELECT DISTINCT {B.label_sql('text', B.RULES)} AS intent FROM documents),
    y AS (SELECT DISTINCT lang AS intent FROM documents)
    SELECT intent, 'left_only' AS side FROM (SELECT intent FROM x EXCEPT SELECT intent FROM y) a
    UNION ALL SELECT intent, 'right_only' FROM (SELECT intent FROM y EXCEPT SELECT intent FROM x) b""",
)
def label_difference(spark, sf):
    docs = B.table(spark, sf, "documents")
    return labels.label_set_difference(
        docs.select(X.first_label("text", B.RULES, "other").alias("intent")), docs.select(F.col("lang").alias("intent"))
    )


@query(
    "U3_strata_union",
    B.with_views("golden", "SELECT intent, count(*) AS n FROM golden GROUP BY 1"),
)
def strata(spark, sf):
    return _golden(spark, sf).groupBy("intent").agg(F.count(F.lit(1)).alias("n"))


@query(
    "H7_apply_reviews",
    B.with_views(
        "golden",
        """SELECT example_id, customer_message, CASE WHEN length(customer_message) % 3 = 0 THEN 'b' ELSE intent END AS intent,
        expected_action, escalation_reason, difficulty,
        CASE WHEN length(customer_message) % 3 = 0 THEN 'human_corrected' ELSE label_source END AS label_source,
        source_case_id FROM golden""",
    ),
)
def apply_reviews(spark, sf):
    gold = _stored(spark, sf)
    corrected = F.length("customer_message") % 3 == 0
    reviews = gold.where(F.length("customer_message") % 3 < 2).select(
        "example_id",
        F.when(corrected, F.lit("b")).otherwise(F.col("intent")).alias("intent"),
        F.when(corrected, F.lit("corrected")).otherwise(F.lit("verified_correct")).alias("review_status"),
    )
    return G.apply_reviews(gold, reviews)
