"""Reply grounding check as one column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from caseloom import config
from caseloom.functions import text as X


def check(reply: Column, n_cases: Column, decision: Column, cfg: config.TriageConfig = config.DEFAULT) -> Column:
    """Struct of the verdict, the issues and the suspicious phrases of a reply."""
    return X.let(X.strip(F.coalesce(reply, F.lit(""))), lambda body: _check_body(body, n_cases, decision, cfg))


def _check_body(body: Column, n_cases: Column, decision: Column, cfg: config.TriageConfig) -> Column:
    found = F.struct(
        X.regex_hits(body, config.COMPLETED_ACTION_PATTERNS).alias("actions"),
        X.regex_hits(body, config.MONEY_PATTERNS).alias("money"),
        X.regex_hits(body, config.DATE_PATTERNS).alias("dates"),
        X.regex_hits(body, config.POLICY_PATTERNS).alias("policies"),
    )
    return X.let(found, lambda hits: _verdict(body, hits, n_cases, decision, cfg))


def _verdict(body: Column, hits: Column, n_cases: Column, decision: Column, cfg: config.TriageConfig) -> Column:
    actions, money, dates, policies = (hits[k] for k in ("actions", "money", "dates", "policies"))
    empty = F.length(body) < cfg.empty_reply_chars
    evidence = F.coalesce(n_cases, F.lit(0)) > 0

    def quoting(issue: str, hits: Column) -> Column:
        return F.when(F.size(hits) > 0, F.concat(F.lit(issue), F.array_join(F.slice(hits, 1, 3), "; ")))

    issues = F.array_compact(
        F.array(
            F.when(empty, F.lit(config.ISSUE_EMPTY)),
            quoting(config.ISSUE_ACTION, actions),
            quoting(config.ISSUE_MONEY, money),
            quoting(config.ISSUE_DATE, dates),
            quoting(config.ISSUE_POLICY, policies),
            F.when(~decision.eqNullSafe("ESCALATE") & ~evidence, F.lit(config.ISSUE_NO_EVIDENCE)),
        )
    )
    return X.let(issues, lambda listed: F.struct(
        (F.size(listed) == 0).alias("supported"),
        listed.alias("issues"),
        actions.alias("completed_action_claims"),
        money.alias("invented_money"),
        dates.alias("invented_dates"),
        policies.alias("policy_claims"),
        empty.alias("empty_reply"),
        evidence.alias("evidence_present"),
    ))
