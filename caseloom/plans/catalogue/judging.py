"""Generated JSON, verdicts, summaries, agreement and review packages."""

from pyspark.sql import functions as F

from caseloom.config import JUDGE_DIMENSIONS as DIMS
from caseloom.config import NO_JUDGE_EXAMPLES
from caseloom.functions.jsonparse import parse_json
from caseloom.operators import judge as J
from caseloom.plans import triage as T
from caseloom.plans.catalogue import bindings as B
from caseloom.plans.catalogue import query
from caseloom.plans.catalogue.answering import RESULT, render_sql, triage_sql
from caseloom.plans.catalogue.similar import QUERIES, looked_up
from caseloom.session import store

CELLS = "case_id, customer_message, predicted_intent, generated_reply"


@query(
    "G5_embedded_json",
    """SELECT event_id, event_id % 5 <> 3 AS parsed,
    CASE WHEN event_id % 5 <> 3 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k FROM events""",
)
def embedded_json(spark, sf):
    r = F.col("event_id") % 5
    raw = (
        F.when(r == 0, F.concat(F.lit("```json\n"), "props", F.lit("\n```")))
        .when(r == 1, F.concat(F.lit("Here it is: "), "props", F.lit(" - done.")))
        .when(r == 2, F.concat(F.lit("```\n"), "props", F.lit("```")))
        .when(r == 3, F.concat(F.lit("```json\n"), F.substring("props", 1, 3)))
        .otherwise(F.col("props"))
    )
    v = parse_json(raw)
    return B.table(spark, sf, "events").select(
        "event_id", v.isNotNull().alias("parsed"), F.try_variant_get(v, "$.k", "bigint").alias("k")
    )


@query(
    "H2_verdict_validation",
    B.with_views(
        "verdicts",
        f"""SELECT case_id, CASE WHEN ok AND n <> 3 AND n <> 5 THEN 'success' ELSE 'failed' END AS status,
        CASE WHEN NOT ok THEN 'Invalid JSON returned by LLM' WHEN n = 3 THEN 'Missing dimension ''safety'' in judge output'
             WHEN n = 5 THEN 'Score for ''relevance'' out of bounds (must be 1-5)' END AS error,
        CASE WHEN ok AND n <> 3 AND n <> 5 THEN round(overall_score, 2) END AS overall_score
        FROM (SELECT *, CAST(substr(case_id, 6) AS BIGINT) % 8 AS n FROM verdicts) v""",
    ),
)
def verdict_validation(spark, sf):
    rows = B.verdicts(spark, sf)
    n = F.substring("case_id", 6, 20).cast("long") % 8
    fields = []
    for d in DIMS:
        score = F.col(f"judge_result.{d}.score")
        if d == "relevance":
            score = F.when(n == 5, F.lit(6)).otherwise(score)
        entry = F.struct(score.alias("score"), F.lit("because").alias("reason"))
        fields.append((F.when(n != 3, entry) if d == "safety" else entry).alias(d))
    text = F.to_json(F.struct(*fields, F.lit("fine").alias("overall_reason")))
    raw = F.when(F.col("judge_result.status") == "success", F.concat(F.lit("```json\n"), text, F.lit("\n```"))).otherwise(
        F.substring(text, 1, 40)
    )
    return rows.select("case_id", J.verdict(raw).alias("v")).select("case_id", "v.status", "v.error", "v.overall_score")


@query("H3_failed_verdicts", B.with_views("verdicts", f"SELECT {CELLS} FROM verdicts WHERE NOT ok"))
def failed(spark, sf):
    return J.failures(B.verdicts(spark, sf)).drop("judge_result")


@query(
    "H4_score_table",
    B.with_views(
        "verdicts", f"SELECT {CELLS}, {', '.join(DIMS)}, overall_score, 'fine' AS overall_reason FROM verdicts WHERE ok"
    ),
)
def score_table(spark, sf):
    return J.score_table(B.verdicts(spark, sf))


@query(
    "H5_quality_band",
    B.with_views(
        "verdicts",
        """SELECT CASE WHEN overall_score >= 4 THEN 'strong' WHEN overall_score = 3 THEN 'acceptable_mixed'
        WHEN overall_score <= 2 THEN 'weak' ELSE 'unbanded' END AS band, count(*) AS n FROM verdicts WHERE ok GROUP BY 1""",
    ),
)
def band(spark, sf):
    scores = J.score_table(B.verdicts(spark, sf))
    return scores.groupBy(J.quality_band(F.col("overall_score")).alias("band")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "H6_review_package",
    B.with_views(
        "verdicts",
        f"""SELECT {CELLS}, '' AS human_relevance, '' AS human_groundedness, '' AS human_resolution_match,
        '' AS human_actionability, '' AS human_safety, '' AS human_overall_score, '' AS human_notes FROM verdicts WHERE NOT ok""",
    ),
)
def package(spark, sf):
    return J.review_package(J.failures(B.verdicts(spark, sf)))


@query(
    "A18_mean_scores",
    B.with_views(
        "verdicts",
        "SELECT " + ", ".join(f"round(avg({d}), 6) AS mean_{d}" for d in (*DIMS, "overall_score")) + " FROM verdicts WHERE ok",
    ),
)
def means(spark, sf):
    m = J.mean_scores(J.score_table(B.verdicts(spark, sf)))
    return m.select(*[F.round(c, 6).alias(c) for c in m.columns])


@query(
    "A19_run_summary",
    B.with_views(
        "verdicts",
        """SELECT count(*) AS total_evaluated, count(*) FILTER (ok) AS successful_judgments,
        count(*) FILTER (NOT ok) AS failed_judgments FROM verdicts""",
    ),
)
def summary(spark, sf):
    return J.run_summary(B.verdicts(spark, sf))


LONG = " UNION ALL ".join(
    f"SELECT '{d}' AS dimension, j.{d} AS j, h.{d} AS h FROM verdicts j JOIN human h USING (case_id) WHERE j.ok AND h.ok" for d in DIMS
)


@query(
    "A25_human_agreement",
    B.with_views(
        "verdicts human",
        f""", pairs AS ({LONG}),
        base AS (SELECT dimension, count(*) AS n, avg(CASE WHEN j = h THEN 1.0 ELSE 0.0 END) AS po, avg(abs(j - h)) AS mad
                 FROM pairs GROUP BY 1),
        pj AS (SELECT dimension, j AS s, count(*) AS c FROM pairs GROUP BY 1, 2),
        ph AS (SELECT dimension, h AS s, count(*) AS c FROM pairs GROUP BY 1, 2),
        pe AS (SELECT pj.dimension AS dimension, CAST(sum(pj.c * ph.c) AS DOUBLE) AS e FROM pj JOIN ph USING (dimension, s) GROUP BY 1)
        SELECT dimension, n, round(po, 6) AS exact_agreement, round(mad, 6) AS mean_absolute_difference,
        round((po - e / (n * n)) / (1 - e / (n * n)), 6) AS cohens_kappa FROM base JOIN pe USING (dimension)""",
    ),
)
def agreement(spark, sf):
    a = J.agreement(J.score_table(B.verdicts(spark, sf)), J.score_table(B.verdicts(spark, sf, 1)))
    return a.select(
        "dimension",
        "n",
        *[F.round(c, 6).alias(c) for c in ("exact_agreement", "mean_absolute_difference", "cohens_kappa")],
    )


@query(
    "L5_evaluation_slice",
    B.with_views(
        "splits",
        "SELECT case_id, intent FROM splits WHERE split = 'validation' ORDER BY customer_tweet_id, brand_tweet_id LIMIT 30",
    ),
)
def slice_(spark, sf):
    from caseloom.plans.catalogue.scoring import _splits

    return J.evaluation_slice(_splits(spark, sf).where("split = 'validation'"), 30).select("case_id", "intent")


THREE_PLACES = "CAST(CAST(CAST(round(score, 4) AS DECIMAL(18, 4)) AS DECIMAL(18, 3)) AS VARCHAR)"
JUDGED = f"""{triage_sql('asked')},
    shown AS (SELECT message_id, CAST(count(*) AS VARCHAR) || chr(10) || string_agg('SIMILARITY: ' || {THREE_PLACES} || chr(10)
              || 'CUSTOMER: ' || l.customer_message || chr(10) || 'BRAND REPLY: ' || l.brand_reply || chr(10), chr(10) ORDER BY place) AS listed
              FROM top JOIN corpus l ON l.customer_tweet_id = top.doc_id GROUP BY 1),
    results AS (SELECT {RESULT}, why FROM grounded),
    prompts AS (SELECT r.*, {render_sql(J.JUDGE_TEMPLATE, {
        "customer_message": "customer_message", "predicted_intent": "intent", "intent_confidence": "CAST(intent_confidence AS VARCHAR)",
        "historical_examples": f"CASE WHEN why = '' AND listed IS NOT NULL THEN listed ELSE {B.quote(NO_JUDGE_EXAMPLES)} END",
        "generated_reply": "reply", "escalation_decision": "decision", "escalation_reason": "escalation_reason"})} AS judge_prompt
      FROM results r LEFT JOIN shown s ON s.message_id = r.message_id)"""


@query("H1_judge_prompt", B.with_views("corpus asked", f", {JUDGED} SELECT message_id, judge_prompt FROM prompts", QUERIES))
def judge_prompts(spark, sf):
    index, asked = looked_up(spark, sf)
    return J.judge_prompt(T.triage(asked, B.rule_classifier, index)).select("message_id", "judge_prompt")


def strict_judge(prompts):
    """Offline judge: scores by prompt length, and broken JSON now and then."""
    import json

    out = []
    for p in prompts:
        scores = {d: {"score": (len(p) + 3 * i) % 5 + 1, "reason": "by length"} for i, d in enumerate(DIMS)}
        text = json.dumps({**scores, "overall_reason": "by length"})
        out.append(text if len(p) % 11 else text[:50])
    return out


SCORES = " + ".join(f"((length(judge_prompt) + {3 * i}) % 5 + 1)" for i in range(len(DIMS)))


@query(
    "H8_judge_run",
    B.with_views(
        "corpus asked held_cases",
        f""", {JUDGED} SELECT case_id, p.intent AS predicted_intent, decision AS escalation_decision,
        CASE WHEN length(judge_prompt) % 11 = 0 THEN 'failed' ELSE 'success' END AS status,
        CASE WHEN length(judge_prompt) % 11 <> 0 THEN round(({SCORES}) / 5.0, 2) END AS overall_score
        FROM prompts p JOIN held_cases h ON h.customer_tweet_id = p.message_id""",
        QUERIES,
    ),
)
def judge_run(spark, sf):
    """The whole validation split, judged."""
    from caseloom.operators import similarity

    splits = store(B.case_splits(spark, sf))
    index = similarity.build_index(splits.where("split = 'train'"), B.STOPS, keep=store)
    return T.judge_run(splits.where("split = 'validation'"), B.rule_classifier, index, strict_judge).select(
        "case_id", "predicted_intent", "escalation_decision", "judge_result.status", "judge_result.overall_score"
    )
