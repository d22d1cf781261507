import json

import pytest
from pyspark.sql import functions as F

from caseloom import config
from caseloom.operators import escalation, grounding, judge, replies, similarity
from caseloom.plans import triage as T
from caseloom.session import store

CASES = [
    ("c1", "my order is late and I want a refund", "Let us look into your order and refund.", "billing_issue", "v1"),
    ("c2", "I cannot log in to my account", "Please reset your password.", "account_access", "v2"),
]
CASE_SCHEMA = "case_id string, customer_message string, brand_reply string, intent string, conversation_id string"
STATE = """message string, c struct<intent:string,confidence:double,top_intents:array<struct<intent:string,probability:double>>>,
    r struct<sufficient:boolean,top_similarity:double>, g boolean, f boolean"""
SURE = ("other", 0.9, [("other", 0.9)])
GOOD = (True, 0.8)


@pytest.mark.parametrize(
    "message, valid, reason",
    [
        (None, False, config.MSG_EMPTY),
        ("", False, config.MSG_EMPTY),
        (" \n ", False, config.MSG_EMPTY),
        ("short", False, config.MSG_TOO_SHORT),
        ("         x", False, config.MSG_TOO_SHORT),
        ("Where is my order?", True, ""),
    ],
)
def test_validation(rows, message, valid, reason):
    v = rows([(message,)], "m string").select(escalation.validate(F.col("m")).alias("v")).first()["v"]
    assert (v["valid"], v["reason"]) == (valid, reason)


def decide(rows, message="Where is my order?", c=SURE, r=GOOD, g=None, f=None, cfg=config.DEFAULT):
    df = rows([(message, c, r, g, f)], STATE)
    e = escalation.decide(F.col("message"), F.col("c"), F.col("r"), F.col("g"), F.col("f"), cfg)
    return df.select(e.alias("e")).first()["e"]


def test_auto_handle(rows):
    e = decide(rows)
    assert (e["decision"], e["reason"]) == ("AUTO_HANDLE", config.REASON_AUTO)
    assert e["signals"]["multi_intent_probability_gap"] is None


@pytest.mark.parametrize(
    "change, reason",
    [
        ({"g": False}, config.REASON_GROUNDING),
        ({"f": True}, config.REASON_GENERATION),
        ({"message": "My account was HACKED"}, config.REASON_HIGH_RISK),
        ({"message": "this issue"}, config.REASON_HIGH_RISK),
        ({"message": "please change my delivery address"}, config.REASON_ACCOUNT_ACTION),
        ({"c": ("a", 0.59, [("a", 0.59)])}, "Low classifier confidence (0.59) below threshold (0.6)."),
        ({"r": (False, 0.1)}, "Insufficient historical evidence (top similarity 0.10) below threshold (0.15)."),
        ({"c": ("a", 0.6, [("a", 0.6), ("b", 0.4501)])}, config.REASON_MULTI_INTENT),
    ],
)
def test_each_rule_escalates(rows, change, reason):
    e = decide(rows, **change)
    assert (e["decision"], e["reason"]) == ("ESCALATE", reason)


def test_reasons_are_joined_in_order(rows):
    e = decide(rows, "fraud, cancel my order", ("a", 0.3, [("a", 0.3), ("b", 0.3)]), (False, 0.0), False, True)
    assert e["reason"].startswith(config.REASON_HIGH_RISK + " " + config.REASON_ACCOUNT_ACTION + " " + config.REASON_MULTI_INTENT)
    assert e["reason"].endswith(config.REASON_GROUNDING + " " + config.REASON_GENERATION)
    assert e["signals"]["high_risk_keywords"] == ["fraud"] and e["signals"]["multi_intent_probability_gap"] == 0.0


def test_switches(rows):
    off = config.TriageConfig(on_high_risk=False, on_weak_retrieval=False)
    assert decide(rows, "fraud, cancel my order", r=(False, 0.0), cfg=off)["decision"] == "AUTO_HANDLE"
    words = config.TriageConfig(word_boundary=True)
    assert decide(rows, "this issue", cfg=words)["decision"] == "AUTO_HANDLE"


@pytest.mark.parametrize(
    "reply, n, decision, supported, claims",
    [
        ("", 1, "AUTO_HANDLE", False, []),
        (None, 1, "ESCALATE", False, []),
        (
            "Your order has been cancelled and you will receive a refund of $50.",
            1,
            "AUTO_HANDLE",
            False,
            ["Your order has been cancelled", "Your order has been cancelled", "order has been"],
        ),
        ("I can help with that. Please try clearing the app cache.", 1, "AUTO_HANDLE", True, []),
        ("I can help with that.", 0, "AUTO_HANDLE", False, []),
        ("I can help with that.", 0, "ESCALATE", True, []),
    ],
)
def test_grounding(rows, reply, n, decision, supported, claims):
    df = rows([(reply, n, decision)], "reply string, n int, d string")
    g = df.select(grounding.check(F.col("reply"), F.col("n"), F.col("d")).alias("g")).first()["g"]
    assert (g["supported"], g["completed_action_claims"]) == (supported, claims)


def test_grounding_issue_texts(rows):
    reply = "You will receive $5 by tomorrow, 2024-01-02. Our policy is clear. 10 dollars, $6, $7"
    df = rows([(reply,)], "reply string")
    g = df.select(grounding.check(F.col("reply"), F.lit(1), F.lit("AUTO_HANDLE")).alias("g")).first()["g"]
    assert g["issues"] == [
        config.ISSUE_ACTION + "You will receive $",
        config.ISSUE_MONEY + "$5; $6; $7",
        config.ISSUE_DATE + "2024-01-02; by tomorrow",
        config.ISSUE_POLICY + "Our policy is",
    ]


def always(df, column):
    """Classifier for tests."""
    top = F.array(F.struct(F.lit("other").alias("intent"), F.lit(0.9).alias("probability")))
    return df.withColumn("classification", F.struct(F.lit("other").alias("intent"), F.lit(0.9).alias("confidence"), top.alias("top_intents")))


@pytest.fixture(scope="module")
def index(spark):
    return similarity.build_index(spark.createDataFrame(CASES, CASE_SCHEMA), keep=store)


MESSAGES = [
    (1, "my order is late, I want a refund"),
    (2, "I cannot log in, I was hacked"),
    (3, ""),
    (4, "unknown wording entirely"),
    (5, None),
]


def run(spark, index, provider=None):
    df = spark.createDataFrame(MESSAGES, "message_id long, message string")
    out = T.triage(df, always, index, provider)
    assert out.columns == ["message_id", *T.RESULT]
    return {r["message_id"]: r for r in out.collect()}


def test_triage_without_provider(spark, index):
    got = run(spark, index)
    assert (got[1]["decision"], got[1]["escalation_reason"], got[1]["reply"]) == ("AUTO_HANDLE", None, config.REPLY_CLARIFY)
    assert [e["case_id"] for e in got[1]["evidence"]][0] == "c1"
    assert len(got[1]["evidence"]) == len(got[1]["retrieval"]["top_cases"])
    assert got[2]["escalation_reason"] == config.REASON_HIGH_RISK
    assert got[2]["reply"] == f"{config.REPLY_HANDOFF} Reason: {config.REASON_HIGH_RISK}"
    for i in (3, 5):
        assert (got[i]["decision"], got[i]["escalation_reason"]) == ("ESCALATE", config.MSG_EMPTY)
        assert (got[i]["reply"], got[i]["generation_status"]) == (config.REPLY_INVALID, "fallback")
        assert got[i]["intent"] is None and got[i]["intent_confidence"] == 0.0 and got[i]["grounding"]["supported"]
    assert got[4]["decision"] == "ESCALATE" and got[4]["retrieval"]["n_results"] == 0


def test_triage_with_provider(spark, index):
    def provider(prompts):
        out = []
        for p in prompts:
            if "hacked" in p:
                out.append(RuntimeError("down"))
                continue
            out.append("Your refund has been sent." if "late" in p else "ok")
        return out

    got = run(spark, index, provider)
    assert (got[1]["decision"], got[1]["escalation_reason"]) == ("ESCALATE", config.REASON_GROUNDING)
    assert got[1]["reply"] == "Your refund has been sent." and not got[1]["grounding"]["supported"]
    assert got[2]["generation_status"] == "failed" and config.REASON_GENERATION in got[2]["escalation_reason"]
    assert got[2]["reply"] == f"{config.REPLY_HANDOFF} {config.REASON_HIGH_RISK}"
    assert got[4]["generation_status"] == "failed" and got[3]["generation_status"] == "fallback"


def test_a_repeated_run_asks_for_nothing_again(spark, index, tmp_path):
    df = spark.createDataFrame(MESSAGES, "message_id long, message string")

    def first(prompts):
        return ["We are looking into it."] * len(prompts)

    def second(prompts):
        raise RuntimeError("asked again")

    got = [sorted(map(str, T.triage(df, always, index, p, answers=str(tmp_path / "l")).collect())) for p in (first, second)]
    assert got[0] == got[1] and any("We are looking into it." in r for r in got[0])


def test_provider_is_asked_once_per_valid_message(spark, index, tmp_path):
    folder = str(tmp_path)

    def provider(prompts):
        import os
        import uuid

        for p in prompts:
            open(os.path.join(folder, uuid.uuid4().hex), "w").write(p)
        return ["We are looking into it."] * len(prompts)

    df = spark.createDataFrame(MESSAGES, "message_id long, message string")
    done = T.triage(df, always, index, provider)
    for _ in range(3):
        done.write.format("noop").mode("overwrite").save()
    valid = done.where("generation_status <> 'fallback'").count()
    assert 0 < valid == len(list(tmp_path.iterdir()))


def test_streaming_batches_leave_no_tables(spark, index, tmp_path):
    from pathlib import Path

    from caseloom.session import shared_folder
    from caseloom.streaming import live

    tables = Path(shared_folder(spark).removeprefix("file:")) / "caseloom"
    before = set(tables.iterdir())
    df = spark.createDataFrame(MESSAGES, "message_id long, message string")
    for i in range(10):
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    live.triage_stream(stream, always, index, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert len([p for p in (tmp_path / "out").iterdir() if p.name.startswith("batch=")]) == 10
    assert set(tables.iterdir()) == before


def test_triage_without_python_stays_in_the_jvm(spark, index):
    df = spark.createDataFrame(MESSAGES, "message_id long, message string")
    plan = T.triage(store(df), always, index)._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapInArrow" not in plan


def test_json_replies(rows):
    raw = json.dumps({"reply": "Hello there", "used_case_ids": ["z"], "confidence": 0.8})
    df = rows([(raw, None), ("plain text reply", None), ("[1, 2, 3]", None), (None, "boom")], "raw string, error string")
    e = F.struct(F.lit("AUTO_HANDLE").alias("decision"), F.lit("").alias("reason"))
    cases = F.array(F.struct(F.lit("c9").alias("case_id")))
    got = [r["o"] for r in df.select(replies.interpret(F.struct("raw", "error"), e, cases).alias("o")).collect()]
    assert (got[0]["reply"], got[0]["used_case_ids"], got[0]["confidence"], got[0]["grounding_summary"]) == ("Hello there", ["z"], 0.8, "")
    assert (got[1]["reply"], got[1]["used_case_ids"], got[1]["confidence"]) == ("plain text reply", ["c9"], 0.5)
    assert got[2]["reply"] == "[1, 2, 3]"
    assert (got[3]["reply"], got[3]["generation_status"], got[3]["grounding_summary"]) == (config.REPLY_CLARIFY, "failed", "Generation failed: boom")


def test_render_does_not_scan_values(rows):
    df = rows([("{b} {a}", "x")], "a string, b string")
    assert df.select(replies.render("<{a}|{b}|{c}>", {"a": F.col("a"), "b": F.col("b")})).first()[0] == "<{b} {a}|x|{c}>"


def test_prompt_holds_the_evidence(spark, index):
    df = similarity.retrieve(spark.createDataFrame([(1, "order refund")], "message_id long, message string"), index)
    e = F.struct(F.lit("ESCALATE").alias("decision"), F.lit("why").alias("reason"))
    c = F.struct(F.lit("billing_issue").alias("intent"), F.lit(0.7).alias("confidence"))
    p = df.select(replies.reply_prompt(F.col("message"), c, F.col("retrieval"), e)).first()[0]
    assert "Example 1:\n  SIMILARITY: " in p and "BRAND REPLY: Let us look into your order and refund." in p and "Reason: why" in p


VALID = {
    "relevance": {"score": 4, "reason": "Good"},
    "groundedness": {"score": 5, "reason": "Great"},
    "resolution_match": {"score": 3, "reason": "Okay"},
    "actionability": {"score": 4, "reason": "Yes"},
    "safety": {"score": 5, "reason": "Safe"},
    "overall_reason": "Overall good.",
}


@pytest.mark.parametrize(
    "safety, error",
    [
        ({"score": 5, "reason": "x"}, None),
        ({"score": "5", "reason": "x"}, None),
        ({"score": 5.9, "reason": "x"}, None),
        (None, "Missing dimension 'safety' in judge output"),
        ("good", "Malformed dimension 'safety'"),
        ({"score": 5}, "Malformed dimension 'safety'"),
        ({"score": "five", "reason": "x"}, "Non-integer score for 'safety'"),
        ({"score": "4.7", "reason": "x"}, "Non-integer score for 'safety'"),
        ({"score": None, "reason": "x"}, "Non-integer score for 'safety'"),
        ({"score": 6, "reason": "x"}, "Score for 'safety' out of bounds (must be 1-5)"),
        ({"score": 0, "reason": "x"}, "Score for 'safety' out of bounds (must be 1-5)"),
    ],
)
def test_verdicts(rows, safety, error):
    body = {k: v for k, v in {**VALID, "safety": safety}.items() if v is not None}
    v = rows([(json.dumps(body),)], "raw string").select(judge.verdict(F.col("raw")).alias("v")).first()["v"]
    assert v["error"] == error and v["status"] == ("failed" if error else "success")
    if error is None:
        assert v["overall_score"] == 4.2 and v["safety"]["score"] == 5 and v["overall_reason"] == "Overall good."


def test_broken_verdicts(rows):
    df = rows([('{"relevance": ', None), ("[]", None), (None, "API Error")], "raw string, e string")
    got = [r["v"]["error"] for r in df.select(judge.verdict(F.col("raw"), F.col("e")).alias("v")).collect()]
    assert got == ["Invalid JSON returned by LLM", "Invalid JSON returned by LLM", "API Error"]


def test_judge_run(spark, index):
    validation = spark.createDataFrame(
        [(i, i, f"CASE_{i}", f"my order number {i} is late") for i in range(5)],
        "customer_tweet_id long, brand_tweet_id long, case_id string, customer_message string",
    )

    def provider(prompts):
        return [json.dumps(VALID) if "number 1" in p else "no json" for p in prompts]

    judged = T.judge_run(validation, always, index, provider, n=3)
    summary = judge.run_summary(judged).first().asDict()
    assert summary == {"total_evaluated": 3, "successful_judgments": 1, "failed_judgments": 2}
    assert judge.mean_scores(judge.score_table(judged)).first()["mean_overall_score"] == 4.2
    assert judge.review_package(judge.failures(judged)).count() == 2


def test_agreement_matches_the_formula(rows):
    dims = config.JUDGE_DIMENSIONS
    schema = "case_id string, " + ", ".join(f"{d} int" for d in dims)
    a, b = [1, 2, 3, 3, 5], [1, 2, 2, 3, 4]
    j = rows([(str(i), *[x] * 5) for i, x in enumerate(a)], schema)
    h = rows([(str(i), *[x] * 5) for i, x in enumerate(b)], schema)
    r = judge.agreement(j, h).where("dimension = 'safety'").first()
    expected = sum(a.count(s) * b.count(s) for s in range(1, 6)) / 25
    assert r["exact_agreement"] == pytest.approx(0.6) and r["mean_absolute_difference"] == pytest.approx(0.4)
    assert r["cohens_kappa"] == pytest.approx((0.6 - expected) / (1 - expected))


@pytest.mark.parametrize("score, band", [(4.0, "strong"), (3.0, "acceptable_mixed"), (2.0, "weak"), (3.4, "unbanded"), (2.2, "unbanded")])
def test_bands(rows, score, band):
    assert rows([(score,)], "s double").select(judge.quality_band(F.col("s"))).first()[0] == band
