"""Reply-quality verdicts: prompts, validation, summaries, agreement and review packages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom import config
from caseloom.functions import text as X
from caseloom.functions.jsonparse import is_object, parse_object
from caseloom.operators.replies import render

DIMENSIONS = config.JUDGE_DIMENSIONS

# Own wording; slots are the names in braces.
JUDGE_TEMPLATE = """Rate a drafted support reply. Do not answer the customer.

[message]
{customer_message}

[intent]
{predicted_intent} (confidence {intent_confidence})

[past cases]
{historical_examples}

[drafted reply]
{generated_reply}

[status]
Decision: {escalation_decision}
Reason: {escalation_reason}

Give each of relevance, groundedness, resolution_match, actionability and safety an integer
from 1 (worst) to 5 (best). Return one JSON object: every dimension as
{"score": <1-5>, "reason": "<short>"}, then "overall_score" (their mean, two decimals) and
"overall_reason". No other text."""


def judge_examples(top_cases: Column) -> Column:
    """Number of cases, then similarity, message and reply of each."""
    blocks = F.transform(
        top_cases,
        lambda c: F.concat(
            F.lit("SIMILARITY: "),
            F.format_string("%.3f", F.coalesce(c["similarity_score"], F.lit(0.0))),
            F.lit("\nCUSTOMER: "),
            F.coalesce(c["customer_message"], F.lit("")),
            F.lit("\nBRAND REPLY: "),
            F.coalesce(c["brand_reply"], F.lit("")),
            F.lit("\n"),
        ),
    )
    listed = F.concat_ws("\n", F.size(top_cases).cast("string"), F.array_join(blocks, "\n"))
    return F.when(F.coalesce(F.size(top_cases), F.lit(0)) > 0, listed).otherwise(F.lit(config.NO_JUDGE_EXAMPLES))


def judge_prompt(triaged: DataFrame, template: str = JUDGE_TEMPLATE) -> DataFrame:
    """Add ``judge_prompt`` to triaged messages."""
    slots = {
        "customer_message": F.col("customer_message"),
        "predicted_intent": F.col("intent"),
        "intent_confidence": F.col("intent_confidence"),
        "historical_examples": judge_examples(F.col("retrieval.top_cases")),
        "generated_reply": F.col("reply"),
        "escalation_decision": F.col("decision"),
        "escalation_reason": F.col("escalation_reason"),
    }
    return triaged.withColumn("judge_prompt", render(template, slots))


def verdict(raw: Column, provider_error: Column | None = None) -> Column:
    """Validated verdict of one generated text: scores, reasons, overall score, status and error.

    The error is the one of the first failing dimension.
    """
    provider_error = F.lit(None).cast("string") if provider_error is None else provider_error
    return X.let(parse_object(raw), lambda obj: _validated(raw, obj, provider_error))


def _validated(raw: Column, obj: Column, provider_error: Column) -> Column:
    dims = F.struct(*[_dimension(obj, d).alias(d) for d in DIMENSIONS])
    not_json = F.when(obj.isNull(), F.lit(config.JUDGE_INVALID_JSON))

    def assemble(seen: Column) -> Column:
        ok = seen["error"].isNull()
        scores = [seen["dims"][d]["score"] for d in DIMENSIONS]
        total = sum(scores[1:], scores[0])
        return F.struct(
            *[F.when(ok, F.struct(seen["dims"][d]["score"].alias("score"), seen["dims"][d]["reason"].alias("reason"))).alias(d) for d in DIMENSIONS],
            F.when(ok, F.round(total / F.lit(5.0), 2)).alias("overall_score"),
            F.when(ok, F.coalesce(F.try_variant_get(obj, "$.overall_reason", "string"), F.lit(""))).alias("overall_reason"),
            F.when(ok, F.lit("success")).otherwise(F.lit("failed")).alias("status"),
            seen["error"].alias("error"),
            F.when(~ok, raw).alias("raw"),
        )

    def first_error(found: Column) -> Column:
        error = F.coalesce(provider_error, not_json, *[found[d]["error"] for d in DIMENSIONS])
        return F.struct(found.alias("dims"), error.alias("error"))

    return X.let(X.let(dims, first_error), assemble)


def _dimension(obj: Column, d: str) -> Column:
    """``struct<score, reason, error>`` of one dimension."""

    def inspect(whole: Column) -> Column:
        fields = F.when(is_object(whole), whole)
        kind = F.schema_of_variant(F.try_variant_get(fields, "$.score", "variant"))
        text = X.strip(F.try_variant_get(fields, "$.score", "string"))
        # Numbers lose their fraction; a text counts only when it spells an integer.
        spelled = F.when(F.rlike(text, F.lit(r"\A[+-]?\d{1,9}\z")), text.try_cast("int"))
        number = F.try_variant_get(fields, "$.score", "double").try_cast("int")
        score = F.when(kind == "STRING", spelled).when(kind != "VOID", number)
        complete = F.try_variant_get(fields, "$.reason", "variant").isNotNull() & kind.isNotNull()
        return F.struct(
            whole.isNull().alias("missing"),
            F.coalesce(complete, F.lit(False)).alias("complete"),
            score.alias("score"),
            F.try_variant_get(fields, "$.reason", "string").alias("reason"),
        )

    def judge(seen: Column) -> Column:
        error = (
            F.when(seen["missing"], F.lit(config.JUDGE_MISSING % d))
            .when(~seen["complete"], F.lit(config.JUDGE_MALFORMED % d))
            .when(seen["score"].isNull(), F.lit(config.JUDGE_NON_INTEGER % d))
            .when(~seen["score"].between(1, 5), F.lit(config.JUDGE_OUT_OF_BOUNDS % d))
        )
        return F.struct(seen["score"].alias("score"), seen["reason"].alias("reason"), error.alias("error"))

    return X.let(X.let(F.try_variant_get(obj, f"$.{d}", "variant"), inspect), judge)


def successes(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("judge_result.status") == "success")


def failures(judged: DataFrame) -> DataFrame:
    return judged.where(~F.col("judge_result.status").eqNullSafe("success"))


def score_table(judged: DataFrame) -> DataFrame:
    """Successful verdicts as flat scores."""
    return successes(judged).select(
        "case_id",
        "customer_message",
        "predicted_intent",
        "generated_reply",
        *[F.col(f"judge_result.{d}.score").alias(d) for d in DIMENSIONS],
        F.col("judge_result.overall_score").alias("overall_score"),
        F.col("judge_result.overall_reason").alias("overall_reason"),
    )


def mean_scores(scores: DataFrame) -> DataFrame:
    return scores.agg(*[F.avg(c).alias(f"mean_{c}") for c in (*DIMENSIONS, "overall_score")])


def run_summary(judged: DataFrame) -> DataFrame:
    ok = F.coalesce(F.col("judge_result.status") == "success", F.lit(False))
    return judged.agg(
        F.count(F.lit(1)).alias("total_evaluated"),
        F.count_if(ok).alias("successful_judgments"),
        F.count_if(~ok).alias("failed_judgments"),
    )


def quality_band(score: Column) -> Column:
    """Rubric band; scores between the bands have none."""
    return (
        F.when(score >= 4.0, F.lit("strong"))
        .when(score == 3.0, F.lit("acceptable_mixed"))
        .when(score <= 2.0, F.lit("weak"))
        .otherwise(F.lit("unbanded"))
    )


def review_package(judged: DataFrame) -> DataFrame:
    """Rows for a human reviewer, with empty score columns."""
    return judged.select(
        "case_id",
        "customer_message",
        "predicted_intent",
        "generated_reply",
        *[F.lit("").alias(c) for c in config.HUMAN_REVIEW_COLUMNS],
    )


def agreement(judge_scores: DataFrame, human_scores: DataFrame, key: str = "case_id") -> DataFrame:
    """Exact agreement, mean absolute difference and Cohen's kappa per dimension."""
    long = [
        df.unpivot([key], list(DIMENSIONS), "dimension", name) for df, name in ((judge_scores, "judge"), (human_scores, "human"))
    ]
    pairs = long[0].join(long[1], [key, "dimension"]).where("judge IS NOT NULL AND human IS NOT NULL")
    cells = pairs.groupBy("dimension", "judge", "human").agg(F.count(F.lit(1)).alias("n"))
    observed = cells.groupBy("dimension").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("judge") == F.col("human"), F.col("n")).otherwise(0)).alias("same"),
        F.sum(F.abs(F.col("judge") - F.col("human")) * F.col("n")).alias("distance"),
    )
    by_judge = cells.groupBy("dimension", F.col("judge").alias("score")).agg(F.sum("n").alias("j"))
    by_human = cells.groupBy("dimension", F.col("human").alias("score")).agg(F.sum("n").alias("h"))
    chance = by_judge.join(by_human, ["dimension", "score"]).groupBy("dimension").agg(F.sum(F.col("j").cast("decimal(19,0)") * F.col("h").cast("decimal(19,0)")).alias("c"))
    agree = F.col("same") / F.col("n")
    n = F.col("n").cast("double")  # the square of a count may pass 64 bits
    expected = F.coalesce(F.col("c").cast("double"), F.lit(0.0)) / (n * n)
    return observed.join(chance, "dimension", "left").select(
        "dimension",
        "n",
        agree.alias("exact_agreement"),
        (F.col("distance") / F.col("n")).alias("mean_absolute_difference"),
        F.try_divide(agree - expected, 1 - expected).alias("cohens_kappa"),
    )


def evaluation_slice(validation: DataFrame, n: int = 3, order: tuple = ("customer_tweet_id", "brand_tweet_id")) -> DataFrame:
    """First ``n`` validation cases in key order."""
    return validation.orderBy(*order).limit(n)
