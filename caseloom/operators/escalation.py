"""Input validation and rule-based escalation, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from caseloom import config
from caseloom.functions import text as X


def validate(message: Column, cfg: config.TriageConfig = config.DEFAULT) -> Column:
    """``struct<valid, message, reason>`` with the stripped message."""
    body = F.coalesce(X.strip(message), F.lit(""))
    reason = (
        F.when(body == "", F.lit(config.MSG_EMPTY))
        .when(F.length(body) < cfg.min_message_chars, F.lit(config.MSG_TOO_SHORT))
        .otherwise(F.lit(""))
    )
    return F.struct((reason == "").alias("valid"), body.alias("message"), reason.alias("reason"))


def high_risk_hits(message: Column, cfg: config.TriageConfig = config.DEFAULT) -> Column:
    return X.matching(message, cfg.high_risk_phrases, cfg.word_boundary)


def account_action_hits(message: Column, cfg: config.TriageConfig = config.DEFAULT) -> Column:
    return X.matching(message, cfg.account_action_phrases, cfg.word_boundary)


def probability_gap(top_intents: Column, cfg: config.TriageConfig = config.DEFAULT) -> Column:
    """Distance of the two best classes; NULL with fewer classes than required."""
    gap = F.get(top_intents, F.lit(0))["probability"] - F.get(top_intents, F.lit(1))["probability"]
    return F.when(F.size(top_intents) >= cfg.multi_intent_min_classes, gap)


def decide(
    message: Column,
    classification: Column,
    retrieval: Column,
    grounding_supported: Column | None = None,
    generation_failed: Column | None = None,
    cfg: config.TriageConfig = config.DEFAULT,
) -> Column:
    """``struct<decision, reason, signals>``: escalate if any enabled rule gives a reason."""
    supported = F.coalesce(grounding_supported if grounding_supported is not None else F.lit(None), F.lit(True))
    failed = F.coalesce(generation_failed if generation_failed is not None else F.lit(None), F.lit(False))
    confidence = F.coalesce(classification["confidence"], F.lit(0.0))
    similarity = F.coalesce(retrieval["top_similarity"], F.lit(0.0))
    sufficient = F.coalesce(retrieval["sufficient"], F.lit(False))
    risk, account = high_risk_hits(message, cfg), account_action_hits(message, cfg)
    gap = probability_gap(classification["top_intents"], cfg)
    multi = F.coalesce(gap <= cfg.multi_intent_gap, F.lit(False))

    rules = [
        (cfg.on_high_risk, F.size(risk) > 0, F.lit(config.REASON_HIGH_RISK)),
        (cfg.on_high_risk, F.size(account) > 0, F.lit(config.REASON_ACCOUNT_ACTION)),
        (cfg.on_multi_intent, multi, F.lit(config.REASON_MULTI_INTENT)),
        (
            cfg.on_low_confidence,
            confidence < cfg.confidence_threshold,
            F.format_string(config.REASON_LOW_CONFIDENCE.format(cfg.confidence_threshold), confidence),
        ),
        (
            cfg.on_weak_retrieval,
            ~sufficient,
            F.format_string(config.REASON_WEAK_RETRIEVAL.format(cfg.min_similarity), similarity),
        ),
        (cfg.on_grounding_failure, ~supported, F.lit(config.REASON_GROUNDING)),
        (cfg.on_generation_failure, failed, F.lit(config.REASON_GENERATION)),
    ]
    reason = F.concat_ws(" ", *[F.when(test, text) for enabled, test, text in rules if enabled])
    return F.struct(
        F.when(reason == "", F.lit("AUTO_HANDLE")).otherwise(F.lit("ESCALATE")).alias("decision"),
        F.when(reason == "", F.lit(config.REASON_AUTO)).otherwise(reason).alias("reason"),
        F.struct(
            F.round(confidence, 4).alias("classifier_confidence"),
            F.round(similarity, 4).alias("retrieval_similarity"),
            sufficient.alias("retrieval_sufficient"),
            (F.size(risk) > 0).alias("high_risk"),
            risk.alias("high_risk_keywords"),
            (F.size(account) > 0).alias("account_action"),
            account.alias("account_action_keywords"),
            multi.alias("multi_intent"),
            F.round(gap, 4).alias("multi_intent_probability_gap"),
            supported.alias("grounding_supported"),
            failed.alias("llm_failure"),
        ).alias("signals"),
    )
