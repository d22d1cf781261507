"""Parameters and fixed values.

Everything an operator needs besides its input DataFrames is passed in as a
plain Python value; the values below are the defaults.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values: keyword rules (order is the labelling priority) ---------
INTENT_RULES = (
    ("billing_issue", ("charge", "charged", "billing", "pay", "payment", "credit card", "refund", "money")),
    (
        "subscription_issue",
        ("premium", "family", "student", "subscription", "plan", "upgrade", "downgrade", "cancel"),
    ),
    ("account_access", ("login", "log in", "password", "hacked", "email", "account", "sign in")),
    (
        "playback_issue",
        ("play", "playing", "stop", "pause", "skip", "skipping", "offline", "download", "buffer", "quality"),
    ),
    ("app_bug", ("crash", "crashing", "bug", "update", "glitch", "won't open", "blank", "error")),
    ("feature_inquiry", ("lyrics", "podcast", "playlist", "add", "feature", "when", "missing")),
)
DEFAULT_INTENT = "other"

# --- Fixed values: escalation phrases --------------------------------------
ACCOUNT_ACTION_PHRASES = (
    "change my delivery address",
    "change my address",
    "update my address",
    "cancel my order",
    "cancel the order",
    "unlock my account",
    "unlock account",
    "reset my password",
    "update my payment",
    "change my payment",
    "update payment details",
    "change payment method",
    "delete my account",
    "close my account",
)
HIGH_RISK_PHRASES = (
    "fraud",
    "fraudulent",
    "unauthorized",
    "stolen",
    "hacked",
    "compromised",
    "account takeover",
    "someone used my account",
    "someone accessed my account",
    "identity theft",
    "identity stolen",
    "legal action",
    "lawsuit",
    "sue",
    "threat",
    "threaten",
    "self-harm",
    "hurt myself",
    "suicide",
    "security breach",
    "data breach",
    "charge dispute",
    "dispute charge",
)

# --- Fixed values: grounding patterns (matched case-insensitively) ---------
COMPLETED_ACTION_PATTERNS = (
    r"\byour\s+\w+\s+has\s+been\s+\w+",
    r"\byour\s+\w+\s+has\s+been\s+(updated|changed|cancelled|canceled|removed|reset|unlocked|refunded|sent|processed|resolved)",
    r"\b(order|account|subscription|payment|address|password)\s+has\s+been",
    r"\bi've\s+(cancelled|canceled|updated|changed|removed|reset|unlocked|refunded|sent|processed)",
    r"\bi have\s+(cancelled|canceled|updated|changed|removed|reset|unlocked|refunded|sent|processed)",
    r"\byour\s+refund\s+has\s+been",
    r"\byou\s+will\s+receive\s+\$",
)
MONEY_PATTERNS = (
    r"\$\d+",
    r"\b\d+\s*(dollars|usd)\b",
    r"\brefund\s+of\s+\$",
    r"\bcompensation\s+of\s+\$",
)
DATE_PATTERNS = (
    r"\b(19|20)\d{2}-\d{2}-\d{2}\b",
    r"\b(january|february|march|april|may|june|july|august|september|october|november|december)\s+\d{1,2},\s+\d{4}\b",
    r"\bby\s+(tomorrow|next\s+week|monday|tuesday|wednesday|thursday|friday|saturday|sunday)\b",
)
POLICY_PATTERNS = (
    r"\bour\s+policy\s+(is|states|says)",
    r"\baccording\s+to\s+our\s+(policy|terms|rules)",
    r"\byou\s+are\s+entitled\s+to",
    r"\byou\s+will\s+be\s+(automatically|immediately)\s+(refunded|credited|upgraded|cancelled)",
)

# --- Fixed values: texts that appear in results ----------------------------
MSG_EMPTY = "Empty message."
MSG_TOO_SHORT = "Message is too short to work with."
REASON_HIGH_RISK = "Potential high-risk issue detected; human review required."
REASON_ACCOUNT_ACTION = "Request requires a private account/order action the agent cannot perform."
REASON_MULTI_INTENT = "Multiple independent support issues detected; human review recommended."
REASON_LOW_CONFIDENCE = "Low classifier confidence (%.2f) below threshold ({})."
REASON_WEAK_RETRIEVAL = "Insufficient historical evidence (top similarity %.2f) below threshold ({})."
REASON_GROUNDING = "Grounding check failed; reply contains unsupported claims."
REASON_GENERATION = "LLM generation failed; cannot produce a safe automated reply."
REASON_AUTO = "Sufficient confidence and evidence to auto-handle."
ISSUE_EMPTY = "Reply is empty or too short to be safe."
ISSUE_ACTION = "Reply claims an action was completed: "
ISSUE_MONEY = "Reply contains money figures that may be invented: "
ISSUE_DATE = "Reply contains dates that may be invented: "
ISSUE_POLICY = "Reply contains policy statements not grounded in evidence: "
ISSUE_NO_EVIDENCE = "Auto-handling without any retrieved historical evidence."
REPLY_HANDOFF = (
    "Thank you for reaching out. Based on the information provided, this request needs to be "
    "reviewed by a support specialist who can access your account details."
)
REPLY_CLARIFY = (
    "Thank you for contacting support. I would like to help, but I need a little more information "
    "to assist you properly. Could you please confirm the details of your request?"
)
REPLY_INVALID = (
    "Thank you for reaching out. Could you please provide a little more detail about your request?"
)
SUMMARY_EMPTY_GENERATION = "Empty or too-short generation; used safe fallback."
SUMMARY_FROM_EVIDENCE = "Reply generated from historical evidence."
SUMMARY_FAILED = "Generation failed: "
NO_EXAMPLES = "(No relevant historical cases found for this request.)"
NO_JUDGE_EXAMPLES = "0\nNo historical cases available."
GOLDEN_LABEL_SOURCE = "keyword_heuristic"
JUDGE_DIMENSIONS = ("relevance", "groundedness", "resolution_match", "actionability", "safety")
EXPECTED_ACTION = "Resolve based on "
CATALOGUE_DESCRIPTION = "Customer issues related to "
CATALOGUE_INCLUDE = "See intent_examples.csv for examples"
CATALOGUE_EXCLUDE = "N/A"
CATALOGUE_ACTION = "Provide relevant troubleshooting or account link"
CATALOGUE_RISK = "low"
JUDGE_INVALID_JSON = "Invalid JSON returned by LLM"
JUDGE_MISSING = "Missing dimension '%s' in judge output"
JUDGE_MALFORMED = "Malformed dimension '%s'"
JUDGE_NON_INTEGER = "Non-integer score for '%s'"
JUDGE_OUT_OF_BOUNDS = "Score for '%s' out of bounds (must be 1-5)"
HUMAN_REVIEW_COLUMNS = (
    "human_relevance",
    "human_groundedness",
    "human_resolution_match",
    "human_actionability",
    "human_safety",
    "human_overall_score",
    "human_notes",
)
CONFIDENCE_BINS = (
    (1, "0.0–0.2", 0.2),
    (2, "0.2–0.4", 0.4),
    (3, "0.4–0.6", 0.6),
    (4, "0.6–0.8", 0.8),
    (5, "0.8–1.0", 1.01),
)


@dataclass(frozen=True)
class TriageConfig:
    """Every threshold and switch of message triage.  The defaults are fixed values too."""

    max_features: int = 5000
    max_iter: int = 1000
    seed: int = 42
    confidence_threshold: float = 0.6
    top_k: int = 3
    min_similarity: float = 0.15
    on_low_confidence: bool = True
    on_weak_retrieval: bool = True
    on_high_risk: bool = True
    on_multi_intent: bool = True
    on_grounding_failure: bool = True
    on_generation_failure: bool = True
    multi_intent_min_classes: int = 2
    multi_intent_gap: float = 0.15
    min_message_chars: int = 10
    empty_reply_chars: int = 5
    high_risk_phrases: tuple = HIGH_RISK_PHRASES
    account_action_phrases: tuple = ACCOUNT_ACTION_PHRASES
    word_boundary: bool = False


DEFAULT = TriageConfig()
