"""The given tables seen as support data, once as DataFrames and once as SQL.

``conversations`` become message tables, ``orders``/``lineitem`` requests with several
dated replies, and ``documents`` a large pool of cases.  Every view covers its whole
table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.functions import text as X
from caseloom.operators import cases, classify, golden, labels, metrics
from caseloom.session import store

# Keyword rules on fragments that the generated prose has; the second set plays the predictor.
RULES = (("a", ("thou", "men")), ("b", ("der",)), ("c", ("wh",)), ("d", ("tion",)))
OTHER_RULES = (("b", ("und", "der")), ("a", ("the",)), ("d", ("tio",)), ("c", ("wh",)))
STOPS = ("the", "and", "of", "to", "in", "die", "der", "und", "la", "de", "le", "les", "an", "on")
SPAN = 1_000_000  # message ids per conversation
SEED = 42
PER_LABEL = 30
EXTRA = 500_000  # added rows have their original's id and so much more


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- messages ---------------------------------------------------------------


def tweets(spark: SparkSession, sf: str) -> DataFrame:
    """All turns; those of the system have no direction."""
    turns = table(spark, sf, "conversations")
    tweet_id = F.col("conv_id") * SPAN + F.col("turn")
    seconds = (F.col("conv_id") * 3600 + F.col("turn") * (300 + F.col("conv_id") % 7 * 60)).cast("double")
    when = F.lit("2017-10-30 08:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    stamp = F.concat(F.date_format(when, "EEE MMM dd HH:mm:ss"), F.lit(" +0000 "), F.date_format(when, "yyyy"))
    return turns.select(
        tweet_id.alias("tweet_id"),
        F.when(F.col("role") == "assistant", F.concat(F.lit("brand_"), (F.col("conv_id") % 5).cast("string")))
        .otherwise(F.col("conv_id").cast("string"))
        .alias("author_id"),
        F.when(F.col("role") == "user", True).when(F.col("role") == "assistant", False).alias("inbound"),
        F.when((F.col("conv_id") + F.col("turn")) % 13 == 0, F.lit("not recorded")).otherwise(stamp).alias("created_at"),
        "text",
        F.when(F.col("turn") > 0, tweet_id - 1).alias("in_response_to_tweet_id"),
    )


def messy(spark: SparkSession, sf: str) -> DataFrame:
    """All messages as they are but for odd direction flags, some of them repeated; added copies with
    missing, blank and one-character texts."""
    rows = tweets(spark, sf)
    conv = F.floor(F.col("tweet_id") / SPAN)
    text = F.when(conv % 11 == 3, F.lit(None)).when(conv % 11 == 4, F.lit("\t  ")).otherwise(F.substring("text", 1, 1))
    added = rows.where(conv % 11 >= 3).where(conv % 11 <= 5).withColumns(
        {c: F.col(c) + EXTRA for c in ("tweet_id", "in_response_to_tweet_id")} | {"text": text}
    )
    every = rows.unionByName(added)
    flag = (
        F.when(F.col("tweet_id") % 17 == 5, F.lit("maybe"))
        .when(F.col("inbound"), F.lit("True"))
        .when(~F.col("inbound"), F.lit("false"))
    )
    times = F.when(conv % 9 == 2, F.lit(2)).otherwise(F.lit(1))
    return every.select(
        "tweet_id", "author_id", flag.alias("inbound"), "created_at", "text", "in_response_to_tweet_id",
        F.explode(F.sequence(F.lit(1), times)).alias("_i"),
    ).drop("_i")


def dated(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as dated customer messages, their line items as dated replies."""
    asked = table(spark, sf, "orders").select(
        (F.col("o_orderkey") * 10).alias("tweet_id"),
        F.col("o_custkey").cast("string").alias("author_id"),
        F.lit(True).alias("inbound"),
        F.col("o_orderdate").cast("string").alias("created_at"),
        F.col("o_orderpriority").alias("text"),
        F.lit(None).cast("long").alias("in_response_to_tweet_id"),
    )
    answered = table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("tweet_id"),
        F.concat(F.lit("supplier_"), F.col("l_suppkey").cast("string")).alias("author_id"),
        F.lit(False).alias("inbound"),
        F.col("l_shipdate").cast("string").alias("created_at"),
        F.concat_ws(" ", "l_returnflag", F.col("l_partkey").cast("string")).alias("text"),
        (F.col("l_orderkey") * 10).alias("in_response_to_tweet_id"),
    )
    return asked.unionByName(answered)


def paired(spark: SparkSession, sf: str) -> DataFrame:
    return cases.build_cases(tweets(spark, sf))


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    return labels.label_messages(paired(spark, sf), RULES)


# --- a larger pool ----------------------------------------------------------


def pool(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as labelled cases."""
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").alias("customer_tweet_id"),
        F.col("doc_id").alias("brand_tweet_id"),
        F.col("text").alias("customer_message"),
        F.col("source").alias("brand_reply"),
        F.col("doc_id").cast("string").alias("conversation_id"),
        F.concat(F.lit("CASE_"), F.col("doc_id").cast("string")).alias("case_id"),
    )
    return labels.label_messages(docs, RULES)


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with a true and a predicted label and a confidence."""
    docs = table(spark, sf, "documents")
    rows = docs.select(
        F.concat(F.lit("GOLD_"), F.col("doc_id").cast("string")).alias("example_id"),
        F.col("text").alias("customer_message"),
        X.first_label("text", RULES, "other").alias("true_intent"),
        X.first_label("text", OTHER_RULES, "other").alias("predicted_intent"),
        ((F.col("n_chars") % 101) / 100.0).alias("confidence"),
    )
    return metrics.prediction_table(rows)


def sources(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        F.concat(F.lit("GOLD_"), F.col("doc_id").cast("string")).alias("example_id"),
        F.concat(F.lit("CASE_"), F.col("doc_id").cast("string")).alias("source_case_id"),
    )


# --- triage -----------------------------------------------------------------


def risky(k, text):
    """Risky wording, a text too short, or a blank one."""
    return (
        F.when(k == 0, F.concat(F.lit("Please CANCEL my order: "), text))
        .when(k == 1, F.substring(text, 1, 5))
        .when(k == 2, F.lit(" \t "))
        .when(k == 3, F.concat(F.lit("I was hacked and unlock account. "), text))
    )


def odd_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Messages added to the given ones: copies with risky wording, too short or blank."""
    k = F.floor(F.col("tweet_id") / SPAN) % 7
    users = tweets(spark, sf).where("inbound").where(k <= 3)
    return users.select((F.col("tweet_id") + EXTRA).alias("message_id"), risky(k, F.col("text")).alias("message"))


def inbox(spark: SparkSession, sf: str) -> DataFrame:
    """All customer messages as they are, and the added ones."""
    users = tweets(spark, sf).where("inbound").select(F.col("tweet_id").alias("message_id"), F.col("text").alias("message"))
    return users.unionByName(odd_messages(spark, sf))


def case_splits(spark: SparkSession, sf: str) -> DataFrame:
    """The labelled cases without golden ones and their messages, split for training and validation."""
    rows = labelled(spark, sf)
    gold = store(golden.golden_set(rows, PER_LABEL, SEED))
    return golden.make_splits(rows, gold, seed=SEED)


def asked(spark: SparkSession, sf: str, splits: DataFrame) -> DataFrame:
    """What is looked up in the training cases: the validation messages as they are, and the added ones."""
    held = splits.where("split = 'validation'").select(F.col("customer_tweet_id").alias("message_id"), F.col("customer_message").alias("message"))
    return held.unionByName(odd_messages(spark, sf))


def rule_classifier(df: DataFrame, column: str) -> DataFrame:
    """Class scores from keyword hits: three more for a class with a hit, one for every class."""
    names = [label for label, _ in RULES] + ["other"]
    weights = [F.when(X.contains_any(column, words), F.lit(4.0)).otherwise(F.lit(1.0)) for _, words in RULES] + [F.lit(1.0)]
    total = sum(weights[1:], weights[0])
    ranked = classify.ranked_intents(F.array(*[w / total for w in weights]), names)
    return df.withColumn("classification", classify.classification(ranked))


def drafts(spark: SparkSession, sf: str) -> DataFrame:
    """Assistant turns as drafted replies, and added copies with unsupported claims or next to no text."""
    rows = tweets(spark, sf).where("NOT inbound")
    k = F.floor(F.col("tweet_id") / SPAN) % 8
    claim = (
        F.when(k == 0, F.lit("Your order has been cancelled and you will receive $50 or 20 USD. "))
        .when(k == 1, F.lit("I've refunded it by next week, on 2024-03-15. Our policy says so. "))
        .when(k == 2, F.lit("You are entitled to a refund of $10 by March 15, 2024. "))
    )
    added = rows.where(k <= 3).select(
        (F.col("tweet_id") + EXTRA).alias("tweet_id"), F.when(k == 3, F.lit(" ok ")).otherwise(F.concat(claim, "text")).alias("text")
    )
    return rows.select("tweet_id", "text").unionByName(added).select(
        F.col("tweet_id").alias("message_id"),
        F.col("text").alias("reply"),
        (F.col("tweet_id") % 3).cast("int").alias("n_cases"),
        F.when(F.col("tweet_id") % 2 == 0, F.lit("ESCALATE")).otherwise(F.lit("AUTO_HANDLE")).alias("decision"),
    )


def verdicts(spark: SparkSession, sf: str, shift: int = 0) -> DataFrame:
    """Typed judge verdicts for the labelled documents, with scores from the ids."""
    d = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "text", "source"), "doc_id")
    from caseloom.config import JUDGE_DIMENSIONS as dims

    scores = [
        ((F.col("doc_id") * (i + 3) + F.col("quality") * 7 + F.when((F.col("doc_id") + i) % 4 == 0, shift).otherwise(0)) % 5 + 1)
        .cast("int")
        for i in range(len(dims))
    ]
    ok = F.col("doc_id") % 10 != 7
    result = F.struct(
        *[F.when(ok, F.struct(s.alias("score"), F.lit("r").alias("reason"))).alias(n) for n, s in zip(dims, scores)],
        F.when(ok, F.round(sum(scores[1:], scores[0]) / 5.0, 2)).alias("overall_score"),
        F.when(ok, F.lit("fine")).alias("overall_reason"),
        F.when(ok, F.lit("success")).otherwise(F.lit("failed")).alias("status"),
        F.when(~ok, F.lit("Invalid JSON returned by LLM")).alias("error"),
    )
    return d.select(
        F.concat(F.lit("CASE_"), F.col("doc_id").cast("string")).alias("case_id"),
        F.col("text").alias("customer_message"),
        F.lit("other").alias("predicted_intent"),
        F.concat(F.lit("See "), F.col("source")).alias("generated_reply"),
        result.alias("judge_result"),
    )


# --- the same views in SQL --------------------------------------------------


def quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def label_sql(column: str, rules, default: str = "other") -> str:
    whens = " ".join(
        "WHEN " + " OR ".join(f"contains(lower({column}), {quote(k)})" for k in words) + f" THEN {quote(label)}"
        for label, words in rules
    )
    return f"CASE {whens} ELSE {quote(default)} END"


def order_sql(*ids: str) -> str:
    return "md5(concat_ws('|', '%d', %s))" % (SEED, ", ".join(f"CAST({i} AS VARCHAR)" for i in ids))


def values_sql(words) -> str:
    return ", ".join(quote(w) for w in words)


BLANK = r"NOT regexp_matches({0}, '[^\x09-\x0D\x1C-\x20\x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}]')"
WS = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def blank_sql(column: str) -> str:
    return f"({column} IS NULL OR {BLANK.format(column)})"


def strip_sql(column: str) -> str:
    return rf"regexp_replace(regexp_replace({column}, '^{WS}+', ''), '{WS}+\z', '')"


WHEN_SQL = "try_strptime(substr({0}, 5), '%b %d %H:%M:%S +0000 %Y')"

CTES = {
    "tweets": f"""
        SELECT c.conv_id * {SPAN} + c.turn AS tweet_id,
               CASE WHEN c.role = 'assistant' THEN 'brand_' || CAST(c.conv_id % 5 AS VARCHAR)
                    ELSE CAST(c.conv_id AS VARCHAR) END AS author_id,
               CASE c.role WHEN 'user' THEN TRUE WHEN 'assistant' THEN FALSE END AS inbound,
               CASE WHEN (c.conv_id + c.turn) % 13 = 0 THEN 'not recorded'
                    ELSE strftime(TIMESTAMP '2017-10-30 08:00:00'
                         + to_seconds(c.conv_id * 3600 + c.turn * (300 + c.conv_id % 7 * 60)),
                         '%a %b %d %H:%M:%S +0000 %Y') END AS created_at,
               c.text AS text,
               CASE WHEN c.turn > 0 THEN c.conv_id * {SPAN} + c.turn - 1 END AS in_response_to_tweet_id
        FROM conversations c""",
    "messy": f"""
        SELECT tweet_id, author_id,
               CASE WHEN tweet_id % 17 = 5 THEN 'maybe' WHEN inbound THEN 'True' WHEN NOT inbound THEN 'false' END AS inbound,
               created_at, text, in_response_to_tweet_id
        FROM (
          SELECT * FROM tweets
          UNION ALL
          SELECT tweet_id + {EXTRA}, author_id, inbound, created_at,
                 CASE (tweet_id // {SPAN}) % 11 WHEN 3 THEN NULL WHEN 4 THEN chr(9) || '  ' ELSE substr(text, 1, 1) END,
                 in_response_to_tweet_id + {EXTRA}
          FROM tweets WHERE (tweet_id // {SPAN}) % 11 BETWEEN 3 AND 5) t,
        LATERAL (SELECT unnest(CASE WHEN (tweet_id // {SPAN}) % 9 = 2 THEN [1, 2] ELSE [1] END)) r""",
    "dated": """
        SELECT o_orderkey * 10 AS tweet_id, CAST(o_custkey AS VARCHAR) AS author_id, TRUE AS inbound,
               o_orderdate AS created, o_orderpriority AS text, CAST(NULL AS BIGINT) AS in_response_to_tweet_id
        FROM orders
        UNION ALL
        SELECT l_orderkey * 10 + l_linenumber, 'supplier_' || CAST(l_suppkey AS VARCHAR), FALSE, l_shipdate,
               concat_ws(' ', l_returnflag, CAST(l_partkey AS VARCHAR)), l_orderkey * 10
        FROM lineitem""",
    "paired": """
        SELECT c.tweet_id AS customer_tweet_id, b.tweet_id AS brand_tweet_id, c.author_id AS customer_user,
               b.author_id AS brand_account, c.text AS customer_message, b.text AS brand_reply,
               c.created_at AS customer_created_at, b.created_at AS brand_created_at,
               CAST(c.tweet_id AS VARCHAR) AS conversation_id, 'CASE_' || CAST(c.tweet_id AS VARCHAR) AS case_id
        FROM tweets c JOIN tweets b ON b.in_response_to_tweet_id = c.tweet_id
        WHERE c.inbound AND NOT b.inbound""",
    "messy_pairs": """
        SELECT c.tweet_id AS customer_tweet_id, b.tweet_id AS brand_tweet_id, c.author_id AS customer_user,
               b.author_id AS brand_account, c.text AS customer_message, b.text AS brand_reply,
               c.created_at AS customer_created_at, b.created_at AS brand_created_at
        FROM messy c JOIN messy b ON b.in_response_to_tweet_id = c.tweet_id
        WHERE lower(c.inbound) = 'true' AND lower(b.inbound) = 'false'""",
    "labelled": f"SELECT *, {label_sql('customer_message', RULES)} AS intent FROM paired",
    "pool": f"""
        SELECT doc_id AS customer_tweet_id, doc_id AS brand_tweet_id, text AS customer_message, source AS brand_reply,
               CAST(doc_id AS VARCHAR) AS conversation_id, 'CASE_' || CAST(doc_id AS VARCHAR) AS case_id,
               {label_sql('text', RULES)} AS intent
        FROM documents""",
    "golden": f"""
        SELECT 'GOLD_' || CAST(row_number() OVER (ORDER BY intent, o, customer_tweet_id) - 1 AS VARCHAR) AS example_id,
               customer_message, intent, 'Resolve based on ' || intent AS expected_action, '' AS escalation_reason,
               CASE WHEN length(customer_message) < 15 OR length(customer_message) > 200
                    THEN 'difficult' ELSE 'normal' END AS difficulty,
               'keyword_heuristic' AS label_source, case_id AS source_case_id
        FROM (SELECT *, {order_sql('customer_tweet_id', 'brand_tweet_id')} AS o FROM pool
              QUALIFY row_number() OVER (PARTITION BY intent ORDER BY o, customer_tweet_id) <= {PER_LABEL}) p""",
    "held": "SELECT * FROM pool WHERE case_id NOT IN (SELECT source_case_id FROM golden)",
    "clean_pool": """
        SELECT * FROM held h
        WHERE NOT EXISTS (SELECT 1 FROM golden g WHERE g.customer_message = h.customer_message)""",
    "splits": f"""
        SELECT *, CASE WHEN row_number() OVER (PARTITION BY intent
                                 ORDER BY {order_sql('customer_tweet_id', 'brand_tweet_id')}, customer_tweet_id)
                         <= ceil(round(0.15 * count(*) OVER (PARTITION BY intent), 9))
                       THEN 'validation' ELSE 'train' END AS split
        FROM clean_pool""",
    "scored": f"""
        SELECT *, true_intent = predicted_intent AS correct FROM (
          SELECT 'GOLD_' || CAST(doc_id AS VARCHAR) AS example_id, text AS customer_message,
                 {label_sql('text', RULES)} AS true_intent, {label_sql('text', OTHER_RULES)} AS predicted_intent,
                 CAST(n_chars % 101 AS DOUBLE) / 100 AS confidence
          FROM documents) d""",
    "pair_counts": "SELECT true_intent AS t, predicted_intent AS p, count(*) AS n FROM scored GROUP BY 1, 2",
    "per_label": """
        SELECT l.intent, CAST(coalesce(sum(n) FILTER (t = l.intent), 0) AS BIGINT) AS support,
               CAST(coalesce(sum(n) FILTER (p = l.intent), 0) AS BIGINT) AS predicted,
               CAST(coalesce(sum(n) FILTER (t = l.intent AND p = l.intent), 0) AS BIGINT) AS tp
        FROM (SELECT t AS intent FROM pair_counts UNION SELECT p FROM pair_counts) l, pair_counts
        GROUP BY l.intent""",
    "label_metrics": """
        SELECT intent, support, predicted, tp,
               CASE WHEN predicted = 0 THEN 0 ELSE CAST(tp AS DOUBLE) / predicted END AS "precision",
               CASE WHEN support = 0 THEN 0 ELSE CAST(tp AS DOUBLE) / support END AS recall,
               CASE WHEN support + predicted = 0 THEN 0 ELSE 2.0 * CAST(tp AS DOUBLE) / (support + predicted) END AS f1
        FROM per_label""",
    "odd": f"""
        SELECT tweet_id + {EXTRA} AS message_id,
               CASE (tweet_id // {SPAN}) % 7
                 WHEN 0 THEN 'Please CANCEL my order: ' || text
                 WHEN 1 THEN substr(text, 1, 5)
                 WHEN 2 THEN ' ' || chr(9) || ' '
                 ELSE 'I was hacked and unlock account. ' || text END AS message
        FROM tweets WHERE inbound AND (tweet_id // {SPAN}) % 7 <= 3""",
    "inbox": "SELECT tweet_id AS message_id, text AS message FROM tweets WHERE inbound UNION ALL SELECT * FROM odd",
    "case_gold": f"""
        SELECT *, {order_sql('customer_tweet_id', 'brand_tweet_id')} AS o FROM labelled
        QUALIFY row_number() OVER (PARTITION BY intent ORDER BY o, customer_tweet_id, brand_tweet_id) <= {PER_LABEL}""",
    "case_splits": f"""
        SELECT *, CASE WHEN row_number() OVER (PARTITION BY intent ORDER BY o, customer_tweet_id, brand_tweet_id)
                         <= ceil(round(0.15 * count(*) OVER (PARTITION BY intent), 9))
                       THEN 'validation' ELSE 'train' END AS split
        FROM (SELECT *, {order_sql('customer_tweet_id', 'brand_tweet_id')} AS o FROM labelled
              WHERE case_id NOT IN (SELECT case_id FROM case_gold)
                AND customer_message NOT IN (SELECT customer_message FROM case_gold)) p""",
    "corpus": "SELECT * FROM case_splits WHERE split = 'train'",
    "held_cases": "SELECT * FROM case_splits WHERE split = 'validation'",
    "asked": "SELECT customer_tweet_id AS message_id, customer_message AS message FROM held_cases UNION ALL SELECT * FROM odd",
    "drafts": f"""
        SELECT tweet_id AS message_id, text AS reply, CAST(tweet_id % 3 AS INTEGER) AS n_cases,
               CASE WHEN tweet_id % 2 = 0 THEN 'ESCALATE' ELSE 'AUTO_HANDLE' END AS decision
        FROM (
          SELECT tweet_id, text FROM tweets WHERE NOT inbound
          UNION ALL
          SELECT tweet_id + {EXTRA},
                 CASE (tweet_id // {SPAN}) % 8
                   WHEN 0 THEN 'Your order has been cancelled and you will receive $50 or 20 USD. ' || text
                   WHEN 1 THEN 'I''ve refunded it by next week, on 2024-03-15. Our policy says so. ' || text
                   WHEN 2 THEN 'You are entitled to a refund of $10 by March 15, 2024. ' || text
                   ELSE ' ok ' END
          FROM tweets WHERE NOT inbound AND (tweet_id // {SPAN}) % 8 <= 3) d""",
}
CTES["dated_pairs"] = """
        SELECT o_orderkey * 10 AS customer_tweet_id, l_orderkey * 10 + l_linenumber AS brand_tweet_id,
               CAST(o_custkey AS VARCHAR) AS customer_user, 'supplier_' || CAST(l_suppkey AS VARCHAR) AS brand_account,
               o_orderpriority AS customer_message, concat_ws(' ', l_returnflag, CAST(l_partkey AS VARCHAR)) AS brand_reply,
               (epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 6e7 AS reply_time_minutes
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey"""


def _verdict_sql(shift: int) -> str:
    from caseloom.config import JUDGE_DIMENSIONS as dims

    scores = ", ".join(
        f"CAST((doc_id * {i + 3} + quality * 7 + CASE WHEN (doc_id + {i}) % 4 = 0 THEN {shift} ELSE 0 END) % 5 + 1 AS INTEGER) AS {d}"
        for i, d in enumerate(dims)
    )
    return f"""
        SELECT *, ({' + '.join(dims)}) / 5.0 AS overall_score FROM (
          SELECT 'CASE_' || CAST(doc_id AS VARCHAR) AS case_id, text AS customer_message,
                 'other' AS predicted_intent, 'See ' || source AS generated_reply,
                 doc_id % 10 <> 7 AS ok, {scores}
          FROM labels JOIN documents USING (doc_id)) v"""


CTES["verdicts"] = _verdict_sql(0)
CTES["human"] = _verdict_sql(1)


def tfidf_ctes(prefix: str, docs: str, vocab: str | None = None, n: int = 5000) -> dict[str, str]:
    """Token counts, vocabulary and unit weights over a ``(doc_id, body)`` relation."""
    out = {
        f"{prefix}_counts": rf"""
            SELECT doc_id, term, count(*) AS tf FROM (
              SELECT doc_id, unnest(regexp_extract_all(lower(body), '[\p{{L}}\p{{N}}_]{{2,}}')) AS term FROM {docs}) w
            WHERE term NOT IN ({values_sql(STOPS)}) GROUP BY 1, 2"""
    }
    if vocab is None:
        vocab = f"{prefix}_vocab"
        out[vocab] = f"""
            SELECT term, frequency, df,
                   ln(((SELECT count(*) FROM {docs}) + 1.0) / (df + 1.0)) + 1.0 AS idf
            FROM (SELECT term, CAST(sum(tf) AS BIGINT) AS frequency, count(*) AS df FROM {prefix}_counts GROUP BY term) t
            ORDER BY frequency DESC, term LIMIT {n}"""
    out[f"{prefix}_weights"] = f"""
            SELECT doc_id, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY doc_id)) AS weight
            FROM {prefix}_counts JOIN {vocab} USING (term)"""
    return out


DEPENDS = {
    "messy": ["tweets"],
    "paired": ["tweets"],
    "messy_pairs": ["messy"],
    "labelled": ["paired"],
    "case_gold": ["labelled"],
    "case_splits": ["case_gold"],
    "corpus": ["case_splits"],
    "held_cases": ["case_splits"],
    "odd": ["tweets"],
    "asked": ["held_cases", "odd"],
    "golden": ["pool"],
    "held": ["golden"],
    "clean_pool": ["held"],
    "splits": ["clean_pool"],
    "pair_counts": ["scored"],
    "per_label": ["pair_counts"],
    "label_metrics": ["per_label"],
    "inbox": ["odd"],
    "drafts": ["tweets"],
}


def with_views(names: str, body: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` clause of the named views and what they need, then the extra ones, then the query."""
    ordered: list[str] = []

    def add(name):
        for d in DEPENDS.get(name, []):
            add(d)
        if name not in ordered:
            ordered.append(name)

    for n in names.split():
        add(n)
    parts = [f"{n} AS ({CTES[n]})" for n in ordered] + [f"{n} AS ({s})" for n, s in (extra or {}).items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body
