"""Golden evaluation set, leakage checks, splits and the review of labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom import config
from caseloom.functions import text as X
from caseloom.operators import skew

GOLDEN_COLUMNS = (
    "example_id",
    "customer_message",
    "intent",
    "expected_action",
    "escalation_reason",
    "difficulty",
    "label_source",
    "source_case_id",
)
KEY = ["customer_tweet_id", "brand_tweet_id"]


def difficulty(c: str = "customer_message", short: int = 15, long: int = 200) -> Column:
    return F.when((F.length(c) < short) | (F.length(c) > long), F.lit("difficult")).otherwise(F.lit("normal"))


def stratified_sample(labelled: DataFrame, n: int = 30, seed: int = config.DEFAULT.seed) -> DataFrame:
    """``min(n, size)`` cases of every label, chosen by a seeded hash of the case key."""
    order = [X.seeded_order(seed, *KEY), *map(F.col, KEY)]
    return skew.top_n_per_group(labelled, ["intent"], order, n, spread=F.struct(*KEY))


def golden_columns(sample: DataFrame) -> DataFrame:
    """Templated and constant columns of a golden example."""
    return sample.select(
        *KEY,
        F.col("customer_message"),
        "intent",
        F.concat(F.lit(config.EXPECTED_ACTION), F.col("intent")).alias("expected_action"),
        F.lit("").alias("escalation_reason"),
        difficulty().alias("difficulty"),
        F.lit(config.GOLDEN_LABEL_SOURCE).alias("label_source"),
        F.col("case_id").alias("source_case_id"),
    )


def number_examples(golden: DataFrame, seed: int = config.DEFAULT.seed) -> DataFrame:
    """``GOLD_0..`` by label and sample order.

    The number of an example is its rank inside its label plus the size of the labels
    before it, so the labels are ranked side by side.
    """
    in_label = Window.partitionBy("intent").orderBy(X.seeded_order(seed, *KEY), *KEY)
    sizes = golden.groupBy("intent").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("intent").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("intent", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    numbered = golden.withColumn("_rank", F.row_number().over(in_label)).join(offsets, "intent")
    number = (F.col("_offset") + F.col("_rank") - 1).cast("string")
    return numbered.withColumn("example_id", F.concat(F.lit("GOLD_"), number)).drop("_rank", "_offset")


def golden_set(labelled: DataFrame, n: int = 30, seed: int = config.DEFAULT.seed) -> DataFrame:
    sample = golden_columns(stratified_sample(labelled, n, seed))
    return number_examples(sample, seed).select(*GOLDEN_COLUMNS)


def golden_quality(golden: DataFrame, label_source: str = config.GOLDEN_LABEL_SOURCE) -> DataFrame:
    """Quality figures as (metric, value) rows."""
    one_row = golden.agg(
        F.count(F.lit(1)).cast("string").alias("total_examples"),
        (
            F.count(F.lit(1))
            - F.countDistinct("customer_message")
            - F.least(F.count_if(F.col("customer_message").isNull()), F.lit(1))
        )
        .cast("string")
        .alias("duplicate_examples"),
        F.count_if(F.col("customer_message").isNull()).cast("string").alias("empty_messages"),
        F.count_if(F.col("difficulty") == "difficult").cast("string").alias("difficult_examples"),
        F.countDistinct("intent").cast("string").alias("number_of_intents"),
    ).withColumn("label_source", F.lit(label_source))
    return one_row.unpivot([], one_row.columns, "metric", "value")


def review_queue(golden: DataFrame) -> DataFrame:
    return golden.where(F.col("difficulty") == "difficult").select(
        "*", F.lit("pending").alias("review_status"), F.lit("").alias("reviewer_notes")
    )


def spot_check(golden: DataFrame, n: int = 30, seed: int = config.DEFAULT.seed) -> DataFrame:
    """Seeded sample of the examples that were not flagged."""
    normal = golden.where(F.col("difficulty") == "normal")
    return normal.orderBy(X.seeded_order(seed, "example_id"), "example_id").limit(n)


def apply_reviews(golden: DataFrame, reviews: DataFrame) -> DataFrame:
    """Take over reviewed labels: ``corrected`` replaces the label, anything else keeps it."""
    r = reviews.select("example_id", F.col("intent").alias("_intent"), "review_status")
    fixed = F.coalesce(F.col("review_status") == "corrected", F.lit(False))
    return (
        golden.join(r, "example_id", "left")
        .withColumn("intent", F.when(fixed, F.col("_intent")).otherwise(F.col("intent")))
        .withColumn("label_source", F.when(fixed, F.lit("human_corrected")).otherwise(F.col("label_source")))
        .select(*GOLDEN_COLUMNS)
    )


def hold_out(cases: DataFrame, golden: DataFrame) -> DataFrame:
    """Cases whose id is not the source of a golden example."""
    ids = golden.where(F.col("source_case_id").isNotNull()).select(F.col("source_case_id").alias("case_id"))
    return cases.join(ids.distinct(), "case_id", "left_anti").select(*cases.columns)


def golden_messages(golden: DataFrame) -> DataFrame:
    return golden.where(F.col("customer_message").isNotNull()).select("customer_message").distinct()


def leaked_messages(pool: DataFrame, golden: DataFrame) -> DataFrame:
    """Pool cases whose message equals a golden message."""
    return pool.join(golden_messages(golden), "customer_message", "left_semi").select(*pool.columns)


def without_leaked_messages(pool: DataFrame, golden: DataFrame) -> DataFrame:
    """Pool without those cases; a missing message is never a leak."""
    return pool.join(golden_messages(golden), "customer_message", "left_anti").select(*pool.columns)


def leaked_conversations(pool: DataFrame, cases: DataFrame, golden: DataFrame) -> DataFrame:
    """Pool cases of a conversation that a golden example comes from."""
    ids = golden.where(F.col("source_case_id").isNotNull()).select(F.col("source_case_id").alias("case_id")).distinct()
    conversations = cases.join(ids, "case_id", "left_semi").select("conversation_id").distinct()
    return pool.join(conversations, "conversation_id", "left_semi").select(*pool.columns)


def leakage_report(cases: DataFrame, golden: DataFrame) -> DataFrame:
    """Both leakage counts, one row each."""
    pool = hold_out(cases, golden)
    checks = {
        "exact_duplicate_messages": leaked_messages(pool, golden),
        "conversation_overlap": leaked_conversations(pool, cases, golden),
    }
    rows = [d.agg(F.count(F.lit(1)).alias("n")).withColumn("check", F.lit(c)) for c, d in checks.items()]
    return rows[0].unionByName(rows[1])


def train_validation_split(pool: DataFrame, share: float = 0.15, seed: int = config.DEFAULT.seed) -> DataFrame:
    """Add ``split``; of every label exactly ``ceil(share * size)`` cases go to validation."""
    flagged = skew.smallest_share(pool, "intent", X.seeded_order(seed, *KEY), KEY, share)
    return flagged.withColumn("split", F.when(F.col("picked"), F.lit("validation")).otherwise(F.lit("train"))).drop("picked")


def make_splits(labelled: DataFrame, golden: DataFrame, share: float = 0.15, seed: int = config.DEFAULT.seed) -> DataFrame:
    """Hold out golden cases, remove leaked messages and split what is left."""
    return train_validation_split(without_leaked_messages(hold_out(labelled, golden), golden), share, seed)
