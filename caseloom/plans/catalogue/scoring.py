"""Baselines and classification reports on rule-based predictions."""

from pyspark.sql import functions as F

from caseloom.operators import metrics as M
from caseloom.plans import evaluation
from caseloom.plans.catalogue import bindings as B
from caseloom.plans.catalogue import query
from caseloom.session import store

PREDICTION = "example_id, true_intent, predicted_intent, correct, confidence"
SCALARS = """overall AS (SELECT CAST(sum(tp) AS DOUBLE) / sum(support) AS accuracy, avg("precision") AS macro_precision,
    avg(recall) AS macro_recall, avg(f1) AS macro_f1, sum(f1 * support) / sum(support) AS weighted_f1 FROM label_metrics)"""


def _report_sql(model):
    scalars = " UNION ALL ".join(
        f"SELECT '{model}' AS model, '{m}' AS metric, '' AS label, round({m}, 6) AS value FROM overall" for m in M.SCALARS
    )
    per_label = " UNION ALL ".join(
        f"SELECT '{model}', 'per_intent_{m}', intent, round(\"{m}\", 6) FROM label_metrics WHERE support > 0"
        for m in ("f1", "precision", "recall")
    )
    return f"{scalars} UNION ALL {per_label}"


@query(
    "A12_majority_label",
    B.with_views(
        "splits",
        "SELECT intent AS majority_class FROM splits WHERE split = 'train' GROUP BY 1 ORDER BY count(*) DESC, intent LIMIT 1",
    ),
)
def majority(spark, sf):
    return M.majority_label(_splits(spark, sf).where("split = 'train'"))


def _splits(spark, sf):
    from caseloom.operators import golden as G

    gold = store(G.golden_set(B.pool(spark, sf), B.PER_LABEL, B.SEED))
    return G.make_splits(B.pool(spark, sf), gold, seed=B.SEED)


@query("M9_prediction_table", B.with_views("scored", f"SELECT {PREDICTION} FROM scored"))
def predictions(spark, sf):
    return B.scored(spark, sf).drop("customer_message")


@query("A14_label_metrics", B.with_views(
    "label_metrics",
    """SELECT intent, support, predicted, tp, round("precision", 6) AS "precision", round(recall, 6) AS recall,
    round(f1, 6) AS f1 FROM label_metrics"""))
def label_metrics(spark, sf):
    m = M.label_metrics(M.pair_counts(B.scored(spark, sf)))
    return m.select("intent", "support", "predicted", "tp", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@query("A14_classification_report", B.with_views("label_metrics", f", {SCALARS} {_report_sql('rules')}"))
def report(spark, sf):
    return M.classification_report(B.scored(spark, sf), "rules").withColumn("value", F.round("value", 6))


@query(
    "A15_confusion_matrix",
    B.with_views(
        "scored",
        "SELECT true_intent, "
        + ", ".join(f"count(*) FILTER (predicted_intent = '{x}') AS {x}" for x in ("a", "b", "c", "d", "other"))
        + " FROM scored GROUP BY 1",
    ),
)
def matrix(spark, sf):
    return M.confusion_matrix(B.scored(spark, sf), ["a", "b", "c", "d", "other"])


@query(
    "A16_confidence_bins",
    B.with_views(
        "scored",
        """SELECT conf_bin, count(*) FILTER (NOT correct) AS incorrect_predictions, count(*) FILTER (correct) AS correct_predictions
        FROM (VALUES ('0.0–0.2', -0.1, 0.2), ('0.2–0.4', 0.2, 0.4), ('0.4–0.6', 0.4, 0.6), ('0.6–0.8', 0.6, 0.8),
                     ('0.8–1.0', 0.8, 1.01)) b(conf_bin, lo, hi)
        LEFT JOIN scored ON confidence > CAST(lo AS DOUBLE) AND confidence <= CAST(hi AS DOUBLE) GROUP BY 1""",
    ),
)
def bins(spark, sf):
    return M.confidence_bins(B.scored(spark, sf))


@query(
    "A17_confusion_pairs",
    B.with_views("scored", "SELECT true_intent, predicted_intent, count(*) AS n FROM scored WHERE NOT correct GROUP BY 1, 2"),
)
def confusion_pairs(spark, sf):
    return M.confusion_pairs(B.scored(spark, sf))


@query(
    "L4_top_confusions",
    B.with_views(
        "scored",
        """SELECT true_intent, predicted_intent, count(*) AS n FROM scored WHERE NOT correct GROUP BY 1, 2
        ORDER BY n DESC, true_intent, predicted_intent LIMIT 5""",
    ),
)
def top_confusions(spark, sf):
    return M.top_confusions(B.scored(spark, sf))


ERRORS = B.with_views(
    "scored", f"SELECT {PREDICTION}, 'CASE_' || substr(example_id, 6) AS source_case_id FROM scored WHERE NOT correct"
)


@query("M10_error_table", ERRORS)
def errors(spark, sf):
    return M.error_table(B.scored(spark, sf), B.sources(spark, sf)).drop("customer_message")


@query("L2_errors_by_confidence", ERRORS + " ORDER BY confidence DESC, example_id")
def surest_errors(spark, sf):
    return M.error_table(B.scored(spark, sf), B.sources(spark, sf)).drop("customer_message")


@query("J7_source_lookup", B.with_views("scored", "SELECT example_id, correct, 'CASE_' || substr(example_id, 6) AS source_case_id FROM scored"))
def lookup(spark, sf):
    return B.scored(spark, sf).select("example_id", "correct").join(B.sources(spark, sf), "example_id", "left")


def _majority_sql(final):
    extra = {
        "majority": "SELECT intent FROM splits WHERE split = 'train' GROUP BY 1 ORDER BY count(*) DESC, intent LIMIT 1",
        "pair_counts": """SELECT intent AS t, (SELECT intent FROM majority) AS p, count(*) AS n FROM golden GROUP BY 1""",
        "per_label": B.CTES["per_label"],
        "label_metrics": B.CTES["label_metrics"],
    }
    return B.with_views("splits", f", {SCALARS} {final}", extra)


@query("M8_majority_baseline", _majority_sql(_report_sql("Majority Baseline")))
def majority_baseline(spark, sf):
    from caseloom.operators import golden as G

    gold = store(G.golden_set(B.pool(spark, sf), B.PER_LABEL, B.SEED))
    train = G.make_splits(B.pool(spark, sf), gold, seed=B.SEED).where("split = 'train'")
    return evaluation.majority_report(train, gold).withColumn("value", F.round("value", 6))


@query(
    "A24_model_comparison",
    B.with_views(
        "label_metrics",
        f""", {SCALARS},
        one AS (SELECT * FROM overall)
        SELECT 'rules' AS model, {', '.join(f'round({m}, 6) AS {m}' for m in M.SCALARS)} FROM one
        UNION ALL SELECT 'perfect', 1.0, 1.0, 1.0, 1.0, 1.0""",
    ),
)
def comparison(spark, sf):
    scored = B.scored(spark, sf)
    perfect = scored.withColumn("predicted_intent", F.col("true_intent"))
    table = M.compare_models([M.classification_report(scored, "rules"), M.classification_report(perfect, "perfect")])
    return table.select("model", *[F.round(m, 6).alias(m) for m in M.SCALARS])
