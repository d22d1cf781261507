"""Whole batches of messages through validation, classification, retrieval, escalation, reply and grounding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom import config, schemas
from caseloom.operators import classify as C
from caseloom.operators import escalation, grounding, judge, ledger, replies, similarity
from caseloom.sources.readers import read_sample_messages
from caseloom.session import store
from caseloom.sources.writers import write_json

Classifier = Callable[[DataFrame, str], DataFrame]
RESULT = (
    "customer_message",
    "intent",
    "intent_confidence",
    "top_intents",
    "retrieval",
    "decision",
    "escalation_reason",
    "reply",
    "grounding",
    "evidence",
    "generation_status",
)


def with_model(model: PipelineModel) -> Classifier:
    return lambda df, column: C.classify(df, model, column)


def triage(
    messages: DataFrame,
    classifier: Classifier,
    index: similarity.CaseIndex | None,
    provider: replies.ReplyBatch | None = None,
    cfg: config.TriageConfig = config.DEFAULT,
    message_id: str = "message_id",
    message: str = "message",
    extra: tuple = (),
    template: str = replies.REPLY_TEMPLATE,
    keep: Callable[[DataFrame], DataFrame] = store,
    answers: str | None = None,
) -> DataFrame:
    """One result row per message, keyed by ``message_id``.

    Without a provider the replies are column expressions and no Python runs.  Invalid
    messages have no text to classify or search, and are answered with a fixed reply.
    ``answers`` names the folder of a ledger, which keeps what a provider was paid for.
    """
    rows = messages.select(
        message_id, *extra, F.col(message).alias("customer_message"), escalation.validate(F.col(message), cfg).alias("check")
    ).withColumn("text", F.when(F.col("check.valid"), F.col("check.message")))
    rows = classifier(rows, "text")
    if index is None:
        rows = rows.withColumn("retrieval", similarity.no_result())
    else:
        rows = similarity.retrieve(rows, index, cfg.top_k, cfg.min_similarity, message_id, "text", keep=keep)
    text, cls, ret = F.col("text"), F.col("classification"), F.col("retrieval")
    rows = rows.withColumn("first", escalation.decide(text, cls, ret, cfg=cfg))
    rows = rows.withColumn("drafted", _draft(rows)) if provider is None else _generate(rows, provider, cfg, template, keep, answers)
    checked = grounding.check(F.col("drafted.reply"), F.size("retrieval.top_cases"), F.col("first.decision"), cfg)
    rows = rows.withColumn("grounding", checked)
    failed = F.col("drafted.generation_status") == "failed"
    rows = rows.withColumn("final", escalation.decide(text, cls, ret, F.col("grounding.supported"), failed, cfg))
    return _result(rows, message_id, extra)


def _draft(rows: DataFrame):
    ids = F.transform("retrieval.top_cases", lambda c: c["case_id"])
    return F.struct(
        replies.template_reply(F.col("first")).alias("reply"),
        F.lit(config.SUMMARY_FROM_EVIDENCE).alias("grounding_summary"),
        ids.alias("used_case_ids"),
        F.lit(0.5).alias("confidence"),
        F.lit("ok").alias("generation_status"),
    )


def _generate(rows: DataFrame, provider, cfg, template, keep, answers) -> DataFrame:
    """Drafts by the provider.  All rows take one way, those of invalid messages with no prompt; the
    answers are kept, so that whatever is done with the results asks the provider once."""
    prompt = replies.reply_prompt(F.col("text"), F.col("classification"), F.col("retrieval"), F.col("first"), template)
    asked = _ask(rows.withColumn("prompt", F.when(F.col("check.valid"), prompt)), "prompt", provider, "generated", keep, answers)
    answer = replies.interpret(F.col("generated"), F.col("first"), F.col("retrieval.top_cases"), cfg)
    return asked.withColumn("drafted", answer).drop("prompt", "generated")


def _ask(rows: DataFrame, prompt: str, provider, out: str, keep, answers: str | None) -> DataFrame:
    if answers is None:
        return keep(replies.call_provider(rows, prompt, provider, out))
    return ledger.ask_once(rows, prompt, provider, answers, out, keep=keep)


def _result(rows: DataFrame, message_id: str, extra: tuple) -> DataFrame:
    ok = F.col("check.valid")

    def pick(valid, invalid):
        return F.when(ok, valid).otherwise(invalid)

    evidence = F.transform(
        "retrieval.top_cases",
        lambda c: F.struct(
            c["case_id"].alias("case_id"), c["similarity_score"].alias("similarity_score"), c["intent"].alias("intent")
        ),
    )
    empty = F.array().cast("array<string>")
    verdict = F.struct(
        pick(F.col("grounding.supported"), F.lit(True)).alias("supported"),
        pick(F.col("grounding.issues"), empty).alias("issues"),
    )
    reason = F.when(F.col("final.decision") == "ESCALATE", F.col("final.reason"))
    return rows.select(
        message_id,
        *extra,
        "customer_message",
        F.when(ok, F.col("classification.intent")).alias("intent"),
        pick(F.col("classification.confidence"), F.lit(0.0)).alias("intent_confidence"),
        pick(F.col("classification.top_intents"), F.array().cast(schemas.TOP_INTENTS)).alias("top_intents"),
        pick(F.col("retrieval"), similarity.no_result()).alias("retrieval"),
        pick(F.col("final.decision"), F.lit("ESCALATE")).alias("decision"),
        pick(reason, F.col("check.reason")).alias("escalation_reason"),
        pick(F.col("drafted.reply"), F.lit(config.REPLY_INVALID)).alias("reply"),
        verdict.alias("grounding"),
        evidence.alias("evidence"),
        pick(F.col("drafted.generation_status"), F.lit("fallback")).alias("generation_status"),
    )


def triage_samples(
    spark: SparkSession, path: str, out: str, classifier: Classifier, index: similarity.CaseIndex, **options
) -> str:
    """Triage the messages of JSON sample files and write the results as JSON."""
    samples = read_sample_messages(spark, path).withColumn("message_id", F.concat_ws("#", "file", "position"))
    results = triage(samples, classifier, index, extra=("file", "position"), **options)
    return write_json(results.orderBy("file", "position").drop("message_id"), out)


def judge_run(
    validation: DataFrame,
    classifier: Classifier,
    index: similarity.CaseIndex,
    judge_provider: replies.ReplyBatch,
    reply_provider: replies.ReplyBatch | None = None,
    n: int | None = None,
    cfg: config.TriageConfig = config.DEFAULT,
    keep: Callable[[DataFrame], DataFrame] = store,
    answers: str | None = None,
) -> DataFrame:
    """Triage validation cases, all or the first ``n``, and judge every reply: case, reply and ``judge_result``.

    The verdicts are kept, so the judge is asked once; with a ledger in the folder ``answers``
    neither the judge nor the reply provider is asked again by a run that is repeated.
    """
    cases = (validation if n is None else judge.evaluation_slice(validation, n)).select(
        F.concat_ws("/", "customer_tweet_id", "brand_tweet_id").alias("message_id"),
        "case_id",
        F.col("customer_message").alias("message"),
    )
    kinds = [f"{answers}/{kind}" if answers else None for kind in ("replies", "verdicts")]
    done = triage(cases, classifier, index, reply_provider, cfg, extra=("case_id",), keep=keep, answers=kinds[0])
    asked = _ask(judge.judge_prompt(done), "judge_prompt", judge_provider, "judged", keep, kinds[1])
    return asked.select(
        "case_id",
        "customer_message",
        F.col("intent").alias("predicted_intent"),
        F.col("reply").alias("generated_reply"),
        F.col("decision").alias("escalation_decision"),
        judge.verdict(F.col("judged.raw"), F.col("judged.error")).alias("judge_result"),
    )
