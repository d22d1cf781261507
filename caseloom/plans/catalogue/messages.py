"""Sources, filters, pairing, brands, profiles and quality."""

from uuid import uuid4

from pyspark.sql import functions as F

from caseloom.functions import text as X
from caseloom.operators import brands, cases, labels, profile, skew
from caseloom.plans.catalogue import bindings as B
from caseloom.plans.catalogue import query
from caseloom.session import shared_folder, store
from caseloom.sources import threads

TWEET_COLS = "tweet_id, author_id, inbound, created_at, text, in_response_to_tweet_id"
BRAND = "brand_2"


@query("P1_customer_messages", B.with_views("tweets", "SELECT tweet_id, author_id, text FROM tweets WHERE inbound"))
def customers(spark, sf):
    return cases.customer_messages(B.tweets(spark, sf)).select("tweet_id", "author_id", "text")


@query("P1_brand_messages", B.with_views("tweets", "SELECT tweet_id, author_id, text FROM tweets WHERE NOT inbound"))
def brand_rows(spark, sf):
    return cases.brand_messages(B.tweets(spark, sf)).select("tweet_id", "author_id", "text")


@query("P2_author_filter", B.with_views("tweets", f"SELECT tweet_id, text FROM tweets WHERE author_id = '{BRAND}'"))
def author(spark, sf):
    return cases.by_author(B.tweets(spark, sf), BRAND).select("tweet_id", "text")


@query(
    "P3_missing_or_blank",
    B.with_views("messy", f"SELECT tweet_id, {B.blank_sql('text')} AS blank FROM messy"),
)
def blank(spark, sf):
    return B.messy(spark, sf).select("tweet_id", X.is_blank("text").alias("blank"))


MARKED = f"""marked AS (
  SELECT customer_tweet_id, brand_tweet_id, customer_message, brand_reply,
         {B.blank_sql('customer_message')} AS missing_customer, {B.blank_sql('brand_reply')} AS missing_reply,
         row_number() OVER (PARTITION BY customer_tweet_id, brand_tweet_id
                            ORDER BY customer_message NULLS FIRST, brand_reply NULLS FIRST) > 1 AS is_duplicate
  FROM messy_pairs)"""


def _messy_cases(spark, sf):
    return store(cases.build_cases(B.messy(spark, sf)))


@query(
    "P4_case_validity",
    B.with_views(
        "messy_pairs",
        f""", {MARKED} SELECT customer_tweet_id, brand_tweet_id, missing_customer, missing_reply, is_duplicate,
        NOT (missing_customer OR missing_reply OR is_duplicate) AS is_valid FROM marked""",
    ),
)
def validity(spark, sf):
    return cases.partition_cases(_messy_cases(spark, sf)).select(
        *cases.CASE_KEY, "missing_customer", "missing_reply", "is_duplicate", "is_valid"
    )


@query(
    "P4_valid_cases",
    B.with_views(
        "messy_pairs",
        f""", {MARKED} SELECT customer_tweet_id, brand_tweet_id, customer_message, brand_reply FROM marked
        WHERE NOT (missing_customer OR missing_reply OR is_duplicate)""",
    ),
)
def valid(spark, sf):
    return cases.valid_cases(_messy_cases(spark, sf)).select(*cases.CASE_KEY, "customer_message", "brand_reply")


@query(
    "W3_mark_duplicates",
    B.with_views(
        "messy",
        f"""SELECT {TWEET_COLS}, row_number() OVER (PARTITION BY tweet_id ORDER BY text) > 1 AS is_duplicate FROM messy""",
    ),
)
def duplicates(spark, sf):
    return skew.mark_duplicates(B.messy(spark, sf), ["tweet_id"])


@query(
    "A6_case_quality",
    B.with_views(
        "messy_pairs",
        f""", {MARKED} SELECT count(*) AS total_candidate_pairs,
        count(*) FILTER (NOT (missing_customer OR missing_reply OR is_duplicate)) AS valid_pairs,
        count(*) FILTER (missing_customer OR missing_reply OR is_duplicate) AS removed_pairs,
        count(*) FILTER (missing_customer) AS missing_customer_messages,
        count(*) FILTER (missing_reply) AS missing_brand_replies,
        count(*) FILTER (is_duplicate) AS duplicates, 0 AS other_invalid_cases FROM marked""",
    ),
)
def case_quality(spark, sf):
    return cases.case_quality(_messy_cases(spark, sf))


PAIR_COLS = "customer_tweet_id, brand_tweet_id, customer_user, brand_account, customer_message, brand_reply"


@query("J1_pair_messages", B.with_views("paired", f"SELECT {PAIR_COLS} FROM paired"))
def pairs(spark, sf):
    return cases.pair_messages(B.tweets(spark, sf)).drop("customer_created_at", "brand_created_at")


@query("J1_pair_fanout", B.with_views("dated_pairs", f"SELECT {PAIR_COLS} FROM dated_pairs"))
def fanout(spark, sf):
    return cases.pair_messages(B.dated(spark, sf)).drop("customer_created_at", "brand_created_at")


def _threads(spark, df):
    return threads.open_threads(spark, threads.save_threads(df, f"{shared_folder(spark)}/caseloom/threads-{uuid4().hex}"))


@query("J1_bucketed_pairs", B.with_views("dated_pairs", f"SELECT {PAIR_COLS} FROM dated_pairs"))
def bucketed_pairs(spark, sf):
    """The pairs from the bucketed layout of messages and replies."""
    made = _threads(spark, B.dated(spark, sf)).each(cases.pair_messages)
    return made.drop("customer_created_at", "brand_created_at")


@query(
    "X2_reply_latency",
    B.with_views(
        "dated_pairs",
        "SELECT customer_tweet_id, brand_tweet_id, round(reply_time_minutes, 6) AS reply_time_minutes FROM dated_pairs",
    ),
)
def latency(spark, sf):
    timed = cases.add_latency(cases.pair_messages(B.dated(spark, sf)))
    return timed.select(*cases.CASE_KEY, F.round("reply_time_minutes", 6).alias("reply_time_minutes"))


@query(
    "P5_case_table",
    B.with_views(
        "paired",
        f"""SELECT {PAIR_COLS}, conversation_id, case_id,
        epoch_us({B.WHEN_SQL.format('customer_created_at')}) IS NOT NULL AS customer_dated,
        round((epoch_us({B.WHEN_SQL.format('brand_created_at')}) - epoch_us({B.WHEN_SQL.format('customer_created_at')})) / 6e7, 6)
          AS reply_time_minutes FROM paired""",
    ),
)
def case_table(spark, sf):
    return B.paired(spark, sf).select(
        *[c.strip() for c in PAIR_COLS.split(",")],
        "conversation_id",
        "case_id",
        F.col("customer_timestamp").isNotNull().alias("customer_dated"),
        F.round("reply_time_minutes", 6).alias("reply_time_minutes"),
    )


@query(
    "P6_derived_ids",
    B.with_views("paired", "SELECT customer_tweet_id, conversation_id, case_id, 'EX_' || case_id AS example_id FROM paired"),
)
def derived_ids(spark, sf):
    rows = cases.with_case_ids(cases.pair_messages(B.tweets(spark, sf)))
    return rows.select(
        "customer_tweet_id", "conversation_id", "case_id", F.concat(F.lit("EX_"), "case_id").alias("example_id")
    )


@query(
    "X1_clean_text",
    rf"""SELECT DISTINCT text AS original_text,
    coalesce({B.strip_sql(f"regexp_replace(text, '{B.WS}+', ' ', 'g')")}, '') AS clean_text, text FROM documents""",
)
def clean(spark, sf):
    return cases.clean_text(B.table(spark, sf, "documents").select("text"))


@query("U2_distinct_rows", B.with_views("messy", f"SELECT DISTINCT {TWEET_COLS} FROM messy"))
def distinct_rows(spark, sf):
    return B.messy(spark, sf).distinct()


# --- brands -----------------------------------------------------------------

VOLUME = "volume AS (SELECT author_id AS brand, count(*) AS replies FROM tweets WHERE NOT inbound AND author_id IS NOT NULL GROUP BY 1)"
SOURCE_VOLUME = "volume AS (SELECT source AS brand, count(*) AS replies FROM documents GROUP BY 1)"


def _volume(spark, sf):
    return brands.replies_per_brand(B.tweets(spark, sf))


def _source_volume(spark, sf):
    return B.table(spark, sf, "documents").groupBy(F.col("source").alias("brand")).agg(F.count(F.lit(1)).alias("replies"))


@query("A1_replies_per_brand", B.with_views("tweets", f", {VOLUME} SELECT brand, replies FROM volume"))
def volume(spark, sf):
    return _volume(spark, sf)


PROFILE = "brand, replies * 2 AS tweets, replies AS customer_tweets, replies AS brand_replies, replies AS conversations"


@query("A2_brand_profile", B.with_views("tweets", f", {VOLUME} SELECT {PROFILE} FROM volume"))
def brand_profile(spark, sf):
    return brands.brand_profile(_volume(spark, sf))


@query(
    "A3_exact_involvement",
    B.with_views(
        "dated_pairs",
        """SELECT brand_account AS brand, count(*) AS pairs, count(DISTINCT customer_tweet_id) AS customer_tweets,
        count(DISTINCT customer_user) AS customers FROM dated_pairs GROUP BY 1""",
    ),
)
def involvement(spark, sf):
    return brands.exact_involvement(B.dated(spark, sf))


@query(
    "A4_distinct_entities",
    B.with_views(
        "tweets",
        """SELECT 'brands' AS entity, count(DISTINCT author_id) AS n FROM tweets WHERE NOT inbound
        UNION ALL SELECT 'customers', count(DISTINCT author_id) FROM tweets WHERE inbound""",
    ),
)
def entities(spark, sf):
    return brands.distinct_entities(B.tweets(spark, sf))


def _select_sql(volume, low, high):
    return f""", {volume}, ranked AS (
      SELECT *, row_number() OVER (ORDER BY replies DESC, brand) AS r FROM volume QUALIFY r <= 20)
      SELECT {PROFILE} FROM ranked
      WHERE r = coalesce((SELECT min(r) FROM ranked WHERE replies BETWEEN {low} AND {high}),
                         (SELECT max(r) FROM ranked WHERE r = 6))"""


@query("P9_select_brand", B.with_views("tweets", _select_sql(VOLUME, 2, 1_000_000)))
def select_brand(spark, sf):
    return brands.select_brand(_volume(spark, sf), 2, 1_000_000)


@query("P9_select_fallback", "WITH " + _select_sql(SOURCE_VOLUME, 10**8, 10**9).lstrip(", "))
def select_fallback(spark, sf):
    return brands.select_brand(_source_volume(spark, sf), 10**8, 10**9)


@query("L1_top_brands", f"WITH {SOURCE_VOLUME} SELECT brand, replies FROM volume ORDER BY replies DESC, brand LIMIT 10")
def top_brands(spark, sf):
    return brands.top_brands(_source_volume(spark, sf), 10)


@query(
    "J2_replies_to_brand",
    B.with_views(
        "tweets",
        f"""SELECT tweet_id, author_id, text FROM tweets WHERE in_response_to_tweet_id IN
        (SELECT tweet_id FROM tweets WHERE author_id = '{BRAND}')""",
    ),
)
def replies_to(spark, sf):
    return brands.replies_to_brand(B.tweets(spark, sf), BRAND).select("tweet_id", "author_id", "text")


@query(
    "J3_answered_by_brand",
    B.with_views(
        "tweets",
        f"""SELECT tweet_id, author_id, text FROM tweets WHERE tweet_id IN
        (SELECT in_response_to_tweet_id FROM tweets WHERE author_id = '{BRAND}' AND in_response_to_tweet_id IS NOT NULL)""",
    ),
)
def answered(spark, sf):
    return brands.answered_by_brand(B.tweets(spark, sf), BRAND).select("tweet_id", "author_id", "text")


@query(
    "J2_J3_bucketed_brand_links",
    B.with_views(
        "tweets",
        f"""SELECT 'replies' AS part, tweet_id, author_id, text FROM tweets WHERE in_response_to_tweet_id IN
        (SELECT tweet_id FROM tweets WHERE author_id = '{BRAND}')
        UNION ALL SELECT 'answered', tweet_id, author_id, text FROM tweets WHERE tweet_id IN
        (SELECT in_response_to_tweet_id FROM tweets WHERE author_id = '{BRAND}' AND in_response_to_tweet_id IS NOT NULL)""",
    ),
)
def bucketed_links(spark, sf):
    """Both semi joins around a brand from one bucketed layout."""
    laid = _threads(spark, B.tweets(spark, sf))
    replies = laid.each(lambda messages, replies: brands.replies_to_brand(messages, BRAND, replies))
    found = laid.each(lambda messages, replies: brands.answered_by_brand(messages, BRAND, replies))
    parts = replies.withColumn("part", F.lit("replies")).unionByName(found.withColumn("part", F.lit("answered")))
    return parts.select("part", "tweet_id", "author_id", "text")


@query(
    "U1_brand_subset",
    B.with_views(
        "tweets",
        f"""SELECT {TWEET_COLS} FROM tweets WHERE author_id = '{BRAND}'
        OR in_response_to_tweet_id IN (SELECT tweet_id FROM tweets WHERE author_id = '{BRAND}')
        OR tweet_id IN (SELECT in_response_to_tweet_id FROM tweets WHERE author_id = '{BRAND}'
                        AND in_response_to_tweet_id IS NOT NULL)""",
    ),
)
def subset(spark, sf):
    return brands.brand_subset(B.tweets(spark, sf), BRAND)


# --- profiles and quality ---------------------------------------------------


@query(
    "A7_message_quality",
    B.with_views(
        "messy",
        f"""SELECT (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM
          (SELECT count(*) AS n FROM messy GROUP BY {TWEET_COLS}) g) AS duplicate_rows,
        count(*) FILTER (text IS NULL) AS missing_text,
        count(*) FILTER ({B.WHEN_SQL.format('created_at')} IS NULL) AS invalid_timestamps,
        count(*) FILTER (length(text) < 2) AS short_messages,
        count(*) FILTER (length(text) > 300) AS long_messages,
        count(*) FILTER (in_response_to_tweet_id IS NULL) AS missing_reply_link,
        count(*) FILTER (NOT coalesce(lower(inbound) IN ('true', 'false'), FALSE)) AS unexpected_inbound FROM messy""",
    ),
)
def quality(spark, sf):
    return profile.message_quality(B.messy(spark, sf))


@query(
    "P10_unexpected_inbound",
    B.with_views("messy", "SELECT tweet_id, inbound FROM messy WHERE inbound IS NULL OR lower(inbound) NOT IN ('true', 'false')"),
)
def odd_inbound(spark, sf):
    return profile.unexpected_inbound(B.messy(spark, sf)).select("tweet_id", "inbound")


NULLS = " UNION ALL ".join(
    f"SELECT '{c.strip()}' AS column_name, count(*) FILTER ({c} IS NULL) AS missing FROM messy" for c in TWEET_COLS.split(",")
)


@query("A8_null_counts", B.with_views("messy", NULLS))
def nulls(spark, sf):
    return profile.null_counts(B.messy(spark, sf))


def _profile_sql():
    rows = [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint")]
    return " UNION ALL ".join(
        f"SELECT {i} AS position, '{n}' AS column_name, '{t}' AS data_type, count(*) AS n_rows FROM documents"
        for i, (n, t) in enumerate(rows, 1)
    )


@query("A9_table_profile", _profile_sql())
def table_profile(spark, sf):
    return profile.table_profile(B.table(spark, sf, "documents"))


@query(
    "A10_duplicate_rows",
    "SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_rows FROM (SELECT count(*) AS n FROM documents GROUP BY text, lang, source, n_chars) d",
)
def duplicate_rows(spark, sf):
    return profile.duplicate_rows(B.table(spark, sf, "documents").drop("doc_id"))


@query(
    "A20_date_range",
    B.with_views(
        "tweets",
        f"""SELECT min(epoch({B.WHEN_SQL.format('created_at')}))::BIGINT AS first_second,
        max(epoch({B.WHEN_SQL.format('created_at')}))::BIGINT AS last_second FROM tweets""",
    ),
)
def dates(spark, sf):
    return profile.date_range(B.tweets(spark, sf))


@query(
    "A21_length_statistics",
    """SELECT count(*) AS n_texts, round(avg(length(text)), 6) AS mean_chars, round(stddev_samp(length(text)), 6) AS std_chars,
    min(length(text)) AS min_chars, quantile_cont(length(text), 0.25) AS p25, quantile_cont(length(text), 0.5) AS p50,
    quantile_cont(length(text), 0.75) AS p75, max(length(text)) AS max_chars FROM documents""",
)
def length_statistics(spark, sf):
    stats = profile.length_statistics(B.table(spark, sf, "documents"))
    return stats.withColumn("mean_chars", F.round("mean_chars", 6)).withColumn("std_chars", F.round("std_chars", 6))


@query(
    "A22_length_histogram",
    """WITH l AS (SELECT length(text) AS x FROM documents), e AS (SELECT min(x) AS lo, max(x) AS hi FROM l)
    SELECT b.bin AS bin, (SELECT count(*) FROM l, e
      WHERE least(CAST(floor((x - lo) / ((hi - lo) / 50.0)) AS BIGINT), 49) = b.bin) AS n
    FROM range(50) b(bin)""",
)
def histogram(spark, sf):
    return profile.length_histogram(B.table(spark, sf, "documents"))


@query("A23_direction_counts", B.with_views("tweets", "SELECT inbound, count(*) AS n FROM tweets GROUP BY 1"))
def directions(spark, sf):
    return profile.direction_counts(B.tweets(spark, sf))


@query(
    "L3_head_and_tail",
    B.with_views(
        "tweets",
        """SELECT 'head' AS part, tweet_id, text FROM (SELECT * FROM tweets ORDER BY tweet_id LIMIT 5) h
        UNION ALL SELECT 'tail', tweet_id, text FROM (SELECT * FROM tweets ORDER BY tweet_id DESC LIMIT 5) t""",
    ),
)
def head_tail(spark, sf):
    return profile.head_and_tail(B.tweets(spark, sf), ["tweet_id"]).select("part", "tweet_id", "text")


# --- labels -----------------------------------------------------------------


@query(
    "M1_keyword_label",
    B.with_views(
        "messy",
        f"""SELECT tweet_id, text, CASE WHEN text IS NULL THEN 'unknown' ELSE {B.label_sql('text', B.RULES)} END AS intent
        FROM messy""",
    ),
)
def keyword_label(spark, sf):
    rows = B.messy(spark, sf).select("tweet_id", "text")
    return labels.label_messages(rows, B.RULES, "text", null_label="unknown")


def _default_rules_sql():
    from caseloom.config import INTENT_RULES

    return f"SELECT doc_id, {B.label_sql('text', INTENT_RULES)} AS intent FROM documents"


@query("M1_default_rules", _default_rules_sql())
def default_rules(spark, sf):
    return labels.label_messages(B.table(spark, sf, "documents"), column="text").select("doc_id", "intent")


@query(
    "J9_keyword_hits",
    B.with_views(
        "paired",
        f"""SELECT customer_tweet_id, r.intent AS intent, r.keyword AS keyword FROM paired
        JOIN (VALUES {', '.join(f"('{label}', '{w}')" for label, ws in B.RULES for w in ws)}) r(intent, keyword)
          ON contains(lower(customer_message), r.keyword)""",
    ),
)
def keyword_hits(spark, sf):
    return labels.keyword_hits(B.paired(spark, sf).select("customer_tweet_id", "customer_message"), B.RULES).drop(
        "customer_message"
    )


@query(
    "A5_label_distribution",
    B.with_views(
        "labelled",
        "SELECT intent, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM labelled), 6) AS percentage FROM labelled GROUP BY 1",
    ),
)
def distribution(spark, sf):
    return labels.label_distribution(B.labelled(spark, sf)).withColumn("percentage", F.round("percentage", 6))


@query(
    "M2_label_catalogue",
    B.with_views(
        "labelled",
        """SELECT DISTINCT intent, 'Customer issues related to ' || replace(intent, '_', ' ') AS description,
        'See intent_examples.csv for examples' AS include_examples, 'N/A' AS exclude_examples,
        'Provide relevant troubleshooting or account link' AS expected_action, 'low' AS escalation_risk FROM labelled""",
    ),
)
def catalogue(spark, sf):
    return labels.label_catalogue(B.labelled(spark, sf))


@query(
    "W1_examples_per_label",
    B.with_views(
        "labelled",
        """SELECT 'EX_' || case_id AS example_id, customer_message, intent, conversation_id, brand_reply FROM labelled
        QUALIFY row_number() OVER (PARTITION BY intent ORDER BY customer_tweet_id, brand_tweet_id) <= 5""",
    ),
)
def examples(spark, sf):
    return labels.examples_per_label(B.labelled(spark, sf))
