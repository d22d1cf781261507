"""Validation, escalation, grounding, replies and whole-batch triage."""

from uuid import uuid4

from pyspark.sql import functions as F

from caseloom import config
from caseloom.operators import escalation, grounding, ledger, replies, similarity
from caseloom.plans import triage as T
from caseloom.plans.catalogue import bindings as B
from caseloom.plans.catalogue import query
from caseloom.plans.catalogue.similar import QUERIES, looked_up
from caseloom.session import shared_folder, store

q = B.quote
CFG = config.DEFAULT


def list_sql(column, needles):
    whens = ", ".join(f"CASE WHEN contains(lower({column}), {q(n)}) THEN {q(n)} END" for n in needles)
    return f"list_filter([{whens}], lambda x: x IS NOT NULL)"


def joined(names):
    return f"array_to_string({names}, '; ')"


CHECK = f"""checked AS (SELECT message_id, message, coalesce({B.strip_sql('message')}, '') AS body FROM inbox),
    validated AS (SELECT *, CASE WHEN body = '' THEN {q(config.MSG_EMPTY)} WHEN length(body) < 10 THEN {q(config.MSG_TOO_SHORT)}
                  ELSE '' END AS why FROM checked)"""


@query(
    "P12_input_validation",
    B.with_views("inbox", f", {CHECK} SELECT message_id, why = '' AS valid, body AS message, why AS reason FROM validated"),
)
def validation(spark, sf):
    rows = B.inbox(spark, sf).select("message_id", escalation.validate(F.col("message")).alias("v"))
    return rows.select("message_id", "v.valid", "v.message", "v.reason")


@query(
    "E1_high_risk",
    B.with_views(
        "inbox",
        f""", h AS (SELECT message_id, {list_sql('message', CFG.high_risk_phrases)} AS k FROM inbox)
        SELECT message_id, len(k) > 0 AS high_risk, {joined('k')} AS keywords FROM h""",
    ),
)
def high_risk(spark, sf):
    hits = escalation.high_risk_hits(F.col("message"))
    return B.inbox(spark, sf).select("message_id", (F.size(hits) > 0).alias("high_risk"), F.array_join(hits, "; ").alias("keywords"))


@query(
    "E2_account_action",
    B.with_views(
        "inbox",
        f""", h AS (SELECT message_id, {list_sql('message', CFG.account_action_phrases)} AS k FROM inbox)
        SELECT message_id, len(k) > 0 AS account_action, {joined('k')} AS keywords FROM h""",
    ),
)
def account_action(spark, sf):
    hits = escalation.account_action_hits(F.col("message"))
    return B.inbox(spark, sf).select("message_id", (F.size(hits) > 0).alias("account_action"), F.array_join(hits, "; ").alias("keywords"))


NAMES = [label for label, _ in B.RULES] + ["other"]


def classes_sql(column):
    """Ranked class scores of the rule classifier: a sorted list of (k, i, intent)."""
    weights = [
        "CASE WHEN " + " OR ".join(f"contains(lower({column}), {q(w)})" for w in words) + " THEN 4.0::DOUBLE ELSE 1.0::DOUBLE END"
        for _, words in B.RULES
    ] + ["1.0::DOUBLE"]
    cols = ", ".join(f"{w} AS w{i}" for i, w in enumerate(weights))
    total = " + ".join(f"w{i}" for i in [*range(1, len(weights)), 0])
    items = ", ".join(f"{{'k': -(w{i} / ({total})), 'i': {i}, 'intent': '{n}'}}" for i, n in enumerate(NAMES))
    return cols, f"list_sort([{items}])"


def _classes(body):
    cols, ranked = classes_sql(body)
    return f"""weighed AS (SELECT *, {cols} FROM validated),
    classed AS (SELECT *, {ranked} AS ranks FROM weighed),
    classified AS (SELECT *, ranks[1].intent AS intent, round(-ranks[1].k, 4) AS confidence,
                   round(round(-ranks[1].k, 4) - round(-ranks[2].k, 4), 4) AS gap,
                   round(-ranks[1].k, 4) - round(-ranks[2].k, 4) <= 0.15 AS multi FROM classed)"""


@query(
    "E3_multi_intent",
    B.with_views("inbox", f", {CHECK}, {_classes('body')} SELECT message_id, intent, confidence, gap, multi AS multi_intent FROM classified"),
)
def multi_intent(spark, sf):
    rows = B.rule_classifier(B.inbox(spark, sf), "message")
    gap = escalation.probability_gap(F.col("classification.top_intents"))
    return rows.select(
        "message_id",
        "classification.intent",
        "classification.confidence",
        F.round(gap, 4).alias("gap"),
        (gap <= CFG.multi_intent_gap).alias("multi_intent"),
    )


def two_places(x):
    return f"CAST(CAST(CAST({x} AS DECIMAL(18, 4)) AS DECIMAL(18, 2)) AS VARCHAR)"


def reason_sql(supported="TRUE"):
    low = config.REASON_LOW_CONFIDENCE.format(CFG.confidence_threshold).split("%.2f")
    weak = config.REASON_WEAK_RETRIEVAL.format(CFG.min_similarity).split("%.2f")
    return f"""concat_ws(' ',
      CASE WHEN len({list_sql('body', CFG.high_risk_phrases)}) > 0 THEN {q(config.REASON_HIGH_RISK)} END,
      CASE WHEN len({list_sql('body', CFG.account_action_phrases)}) > 0 THEN {q(config.REASON_ACCOUNT_ACTION)} END,
      CASE WHEN multi THEN {q(config.REASON_MULTI_INTENT)} END,
      CASE WHEN confidence < 0.6 THEN {q(low[0])} || {two_places('confidence')} || {q(low[1])} END,
      CASE WHEN NOT sufficient THEN {q(weak[0])} || {two_places('top_similarity')} || {q(weak[1])} END,
      CASE WHEN NOT {supported} THEN {q(config.REASON_GROUNDING)} END)"""


FLAT = f""", {CHECK}, {_classes('body')},
    retrieved AS (SELECT *, message_id % 2 = 0 AS sufficient, CAST(message_id % 100 AS DOUBLE) / 100 AS top_similarity FROM classified),
    decided AS (SELECT *, {reason_sql()} AS why2 FROM retrieved)"""


def _decided(spark, sf):
    rows = B.inbox(spark, sf).select("message_id", escalation.validate(F.col("message")).alias("c")).select("message_id", "c.message")
    rows = B.rule_classifier(rows, "message")
    fake = F.struct(
        (F.col("message_id") % 2 == 0).alias("sufficient"), ((F.col("message_id") % 100) / 100.0).alias("top_similarity")
    )
    return rows.withColumn("e", escalation.decide(F.col("message"), F.col("classification"), fake))


@query(
    "E4_escalation_decision",
    B.with_views(
        "inbox",
        f"""{FLAT} SELECT message_id, CASE WHEN why2 = '' THEN 'AUTO_HANDLE' ELSE 'ESCALATE' END AS decision,
        CASE WHEN why2 = '' THEN {q(config.REASON_AUTO)} ELSE why2 END AS reason, multi AS multi_intent, gap FROM decided""",
    ),
)
def decision(spark, sf):
    rows = _decided(spark, sf)
    return rows.select(
        "message_id",
        "e.decision",
        "e.reason",
        "e.signals.multi_intent",
        F.col("e.signals.multi_intent_probability_gap").alias("gap"),
    )


def hits_sql(column, patterns):
    return "list_concat(" + ", ".join(f"regexp_extract_all({column}, {q('(?i)' + p)}, 0)" for p in patterns) + ")"


def issue_sql(text, hits):
    return f"CASE WHEN len({hits}) > 0 THEN {q(text)} || array_to_string({hits}[1:3], '; ') END"


GROUND = f""", g AS (SELECT message_id, n_cases, decision, {B.strip_sql('reply')} AS body FROM drafts),
    m AS (SELECT *, {hits_sql('body', config.COMPLETED_ACTION_PATTERNS)} AS actions, {hits_sql('body', config.MONEY_PATTERNS)} AS money,
          {hits_sql('body', config.DATE_PATTERNS)} AS dates, {hits_sql('body', config.POLICY_PATTERNS)} AS policies FROM g),
    i AS (SELECT *, list_filter([CASE WHEN length(body) < 5 THEN {q(config.ISSUE_EMPTY)} END,
          {issue_sql(config.ISSUE_ACTION, 'actions')}, {issue_sql(config.ISSUE_MONEY, 'money')},
          {issue_sql(config.ISSUE_DATE, 'dates')}, {issue_sql(config.ISSUE_POLICY, 'policies')},
          CASE WHEN decision <> 'ESCALATE' AND n_cases = 0 THEN {q(config.ISSUE_NO_EVIDENCE)} END], lambda x: x IS NOT NULL) AS issues FROM m)"""


@query(
    "E5_grounding_check",
    B.with_views(
        "drafts",
        f"""{GROUND} SELECT message_id, len(issues) = 0 AS supported, array_to_string(issues, ' / ') AS issues,
        array_to_string(actions, '; ') AS actions, array_to_string(money, '; ') AS money, array_to_string(dates, '; ') AS dates,
        array_to_string(policies, '; ') AS policies, length(body) < 5 AS empty_reply, n_cases > 0 AS evidence_present FROM i""",
    ),
)
def grounding_check(spark, sf):
    rows = B.drafts(spark, sf)
    rows = rows.select("message_id", grounding.check(F.col("reply"), F.col("n_cases"), F.col("decision")).alias("g"))
    return rows.select(
        "message_id",
        "g.supported",
        F.array_join("g.issues", " / ").alias("issues"),
        F.array_join("g.completed_action_claims", "; ").alias("actions"),
        F.array_join("g.invented_money", "; ").alias("money"),
        F.array_join("g.invented_dates", "; ").alias("dates"),
        F.array_join("g.policy_claims", "; ").alias("policies"),
        "g.empty_reply",
        "g.evidence_present",
    )


REPLY = f"""CASE WHEN why2 = '' THEN {q(config.REPLY_CLARIFY)} ELSE {q(config.REPLY_HANDOFF)} || ' Reason: ' || why2 END"""
SAFE = f"""CASE WHEN why2 = '' THEN {q(config.REPLY_CLARIFY)} ELSE {q(config.REPLY_HANDOFF)} || ' ' || why2 END"""


@query("G4_deterministic_replies", B.with_views("inbox", f"{FLAT} SELECT message_id, {REPLY} AS reply, {SAFE} AS safe_reply FROM decided"))
def deterministic(spark, sf):
    rows = _decided(spark, sf)
    return rows.select(
        "message_id", replies.template_reply(F.col("e")).alias("reply"), replies.safe_reply(F.col("e")).alias("safe_reply")
    )


BLOCKS = """blocks AS (SELECT message_id, string_agg('Example ' || CAST(place AS VARCHAR) || ':' || chr(10) || '  SIMILARITY: '
              || CAST(round(score, 4) AS VARCHAR) || chr(10) || '  CUSTOMER: ' || l.customer_message || chr(10)
              || '  BRAND REPLY: ' || l.brand_reply, chr(10) || chr(10) ORDER BY place) AS block
            FROM top JOIN corpus l ON l.customer_tweet_id = top.doc_id GROUP BY 1)"""
EXAMPLES = f"coalesce({B.strip_sql('block')}, {q(config.NO_EXAMPLES)})"


@query(
    "G1_evidence_block",
    B.with_views(
        "corpus asked",
        f", {BLOCKS} SELECT i.message_id AS message_id, {EXAMPLES} AS evidence FROM asked i LEFT JOIN blocks USING (message_id)",
        QUERIES,
    ),
)
def evidence_block(spark, sf):
    index, asked = looked_up(spark, sf)
    rows = similarity.retrieve(asked, index)
    return rows.select("message_id", replies.format_examples(F.col("retrieval.top_cases")).alias("evidence"))


def triage_sql(source, valid_only=True):
    """Every message of a view, checked, classified, searched, decided and grounded."""
    return f"""{CHECK.replace("FROM inbox", "FROM " + source)},
    {_classes('body')},
    {BLOCKS},
    found AS (SELECT message_id, max(score) AS best, count(*) AS n,
              string_agg('CASE_' || CAST(doc_id AS VARCHAR), '; ' ORDER BY place) AS ids FROM top GROUP BY 1),
    retrieved AS (SELECT c.*, coalesce(best >= 0.15, FALSE) AS sufficient, coalesce(round(best, 4), 0.0) AS top_similarity,
                  coalesce(n, 0) AS n_results, coalesce(ids, '') AS ids, block
                  FROM classified c LEFT JOIN found f ON f.message_id = c.message_id {"AND c.why = ''" if valid_only else ""}
                  LEFT JOIN blocks b ON b.message_id = f.message_id),
    decided AS (SELECT *, {reason_sql()} AS why2 FROM retrieved),
    grounded AS (SELECT *, why2 <> '' OR n_results > 0 AS supported FROM decided)"""


def render_sql(template, slots):
    """The filled template as a concatenation."""
    parts, rest = [], template
    while rest:
        found = sorted((rest.index("{%s}" % s), s) for s in slots if "{%s}" % s in rest)
        if not found:
            parts.append(q(rest))
            break
        at, slot = found[0]
        parts += [q(rest[:at]), f"coalesce({slots[slot]}, '')"]
        rest = rest[at + len(slot) + 2 :]
    return " || ".join(parts)


def prompt_sql(message):
    return render_sql(
        replies.REPLY_TEMPLATE,
        {
            "customer_message": message,
            "predicted_intent": "intent",
            "intent_confidence": "CAST(confidence AS VARCHAR)",
            "n_historical_examples": "CAST(n_results AS VARCHAR)",
            "historical_examples": EXAMPLES,
            "escalation_decision": "CASE WHEN why2 = '' THEN 'AUTO_HANDLE' ELSE 'ESCALATE' END",
            "escalation_reason": f"CASE WHEN why2 = '' THEN {q(config.REASON_AUTO)} ELSE why2 END",
        },
    )


@query(
    "G2_reply_prompt",
    B.with_views("corpus asked", f", {triage_sql('asked', False)} SELECT message_id, {prompt_sql('message')} AS prompt FROM decided", QUERIES),
)
def prompts(spark, sf):
    index, asked = looked_up(spark, sf)
    rows = B.rule_classifier(similarity.retrieve(asked, index), "message")
    rows = rows.withColumn("e", escalation.decide(F.col("message"), F.col("classification"), F.col("retrieval")))
    prompt = replies.reply_prompt(F.col("message"), F.col("classification"), F.col("retrieval"), F.col("e"))
    return rows.select("message_id", prompt.alias("prompt"))


def echo(prompts):
    """Offline provider: answers with the decision line, and fails on messages about a hacked account."""
    out = []
    for p in prompts:
        if "hacked" in p:
            out.append(RuntimeError("no answer"))
        else:
            out.append("We are looking into it. " + p.split("Decision: ")[1].split("\n")[0])
    return out


def _triaged(spark, sf, provider=None):
    index, asked = looked_up(spark, sf)
    return T.triage(asked, B.rule_classifier, index, provider)


@query(
    "G3_provider_replies",
    B.with_views(
        "corpus asked",
        f""", {triage_sql('asked')},
        answered AS (SELECT *, why = '' AND contains({prompt_sql('body')}, 'hacked') AS failed FROM grounded),
        final AS (SELECT *, concat_ws(' ', nullif(why2, ''), CASE WHEN NOT supported THEN {q(config.REASON_GROUNDING)} END,
                  CASE WHEN failed THEN {q(config.REASON_GENERATION)} END) AS why3 FROM answered)
        SELECT message_id, CASE WHEN why <> '' OR why3 <> '' THEN 'ESCALATE' ELSE 'AUTO_HANDLE' END AS decision,
        CASE WHEN why <> '' THEN why WHEN why3 <> '' THEN why3 END AS escalation_reason,
        CASE WHEN why <> '' THEN {q(config.REPLY_INVALID)} WHEN failed THEN {SAFE}
             ELSE 'We are looking into it. ' || CASE WHEN why2 = '' THEN 'AUTO_HANDLE' ELSE 'ESCALATE' END END AS reply,
        CASE WHEN why <> '' THEN 'fallback' WHEN failed THEN 'failed' ELSE 'ok' END AS generation_status FROM final""",
        QUERIES,
    ),
)
def provider_replies(spark, sf):
    return _triaged(spark, sf, echo).select("message_id", "decision", "escalation_reason", "reply", "generation_status")


RESULT = f"""message_id, message AS customer_message, CASE WHEN why = '' THEN intent END AS intent,
        CASE WHEN why = '' THEN confidence ELSE 0.0 END AS intent_confidence, top_similarity, n_results,
        CASE WHEN why <> '' OR why2 <> '' OR NOT supported THEN 'ESCALATE' ELSE 'AUTO_HANDLE' END AS decision,
        CASE WHEN why <> '' THEN why WHEN NOT supported THEN {q(config.REASON_GROUNDING)} WHEN why2 <> '' THEN why2 END AS escalation_reason,
        CASE WHEN why <> '' THEN {q(config.REPLY_INVALID)} ELSE {REPLY} END AS reply,
        why <> '' OR supported AS supported, ids AS evidence,
        CASE WHEN why = '' THEN 'ok' ELSE 'fallback' END AS generation_status"""


@query("G6_batch_triage", B.with_views("corpus asked", f", {triage_sql('asked')} SELECT {RESULT} FROM grounded", QUERIES))
def batch_triage(spark, sf):
    return flat(_triaged(spark, sf))


def flat(done):
    """The columns of a triage result that SQL has too."""
    return done.select(
        "message_id",
        "customer_message",
        "intent",
        "intent_confidence",
        "retrieval.top_similarity",
        F.col("retrieval.n_results").cast("long").alias("n_results"),
        "decision",
        "escalation_reason",
        "reply",
        "grounding.supported",
        F.array_join("evidence.case_id", "; ").alias("evidence"),
        "generation_status",
    )


def first_answers(prompts):
    return [RuntimeError("no answer") if "hacked" in p else "first: " + p for p in prompts]


def second_answers(prompts):
    return ["second: " + p for p in prompts]


@query(
    "G3_asked_once",
    B.with_views(
        "inbox",
        """SELECT message_id, CASE WHEN contains(message, 'hacked') THEN 'second: ' ELSE 'first: ' END || message AS answer
        FROM inbox""",
    ),
)
def asked_once(spark, sf):
    """A second run with the same ledger asks only for what failed in the first."""
    rows, place = B.inbox(spark, sf), f"{shared_folder(spark)}/caseloom/ledger-{uuid4().hex}"
    ledger.ask_once(rows, "message", first_answers, place)
    again = ledger.ask_once(rows, "message", second_answers, place)
    return again.select("message_id", F.col("generated.raw").alias("answer"))


@query(
    "G1_evidence_replies",
    B.with_views(
        "corpus asked",
        """SELECT message_id, 'CASE_' || CAST(top.doc_id AS VARCHAR) AS case_id, c.brand_tweet_id AS reply_order, c.brand_reply AS brand_reply
        FROM top JOIN corpus c ON c.customer_tweet_id = top.doc_id""",
        QUERIES,
    ),
)
def evidence_replies(spark, sf):
    """Every reply that the found cases got."""
    index, asked = looked_up(spark, sf)
    found = store(similarity.retrieve(asked, index))
    return similarity.evidence_replies(found, index)
