"""From raw messages to labelled cases, golden set and splits, with every stage written to its own table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from caseloom import config
from caseloom.operators import brands, cases, golden, labels, profile
from caseloom.session import store
from caseloom.sources import writers


def labelled_cases(tweets: DataFrame, rules=config.INTENT_RULES) -> DataFrame:
    """Pair, validate and label; the pairs are stored, since validation reads them three times."""
    return labels.label_messages(cases.valid_cases(store(cases.build_cases(tweets))), rules)


def prepare(
    spark: SparkSession,
    tweets: DataFrame,
    out: str,
    rules=config.INTENT_RULES,
    low: int = 10_000,
    high: int = 50_000,
    per_label: int = 30,
    seed: int = config.DEFAULT.seed,
) -> dict[str, str]:
    """Run every preparation stage and return the paths of its tables."""
    paths = {}

    def keep(name: str, df: DataFrame, **options) -> DataFrame:
        paths[name] = writers.write_parquet(df, f"{out}/{name}", **options)
        return spark.read.parquet(paths[name])

    volume = keep("replies_per_brand", brands.replies_per_brand(tweets))
    keep("brand_analysis", brands.brand_profile(brands.top_brands(volume, 20)))
    choice = keep("selected_brand", brands.select_brand(volume, low, high))
    paths["selected_brand_summary"] = writers.write_summary(writers.brand_summary(choice), f"{out}/selected_brand_summary")
    found = choice.first()
    if found is None:
        raise ValueError(f"no brand has {low} to {high} replies, and there are too few brands to fall back on")
    brand = found["brand"]
    subset = keep("brand_tweets", brands.brand_subset(tweets, brand))
    keep("message_quality", profile.message_quality(subset))
    pairs = keep("candidate_cases", cases.build_cases(subset))
    keep("case_quality", cases.case_quality(pairs))
    labelled = keep("support_cases", labels.label_messages(cases.valid_cases(pairs), rules))
    keep("intent_distribution", labels.label_distribution(labelled))
    keep("intent_examples", labels.examples_per_label(labelled))
    keep("intent_definitions", labels.label_catalogue(labelled))
    gold_path, twin = f"{out}/golden_set", f"{out}/golden_evaluation_set"
    paths["golden_set"], paths["golden_evaluation_set"] = writers.write_twice(
        golden.golden_set(labelled, per_label, seed), gold_path, twin
    )
    gold = spark.read.parquet(gold_path)
    keep("golden_quality", golden.golden_quality(gold))
    keep("golden_distribution", labels.label_distribution(gold))
    keep("review_queue", golden.review_queue(gold))
    keep("leakage_report", golden.leakage_report(labelled, gold))
    keep("splits", golden.make_splits(labelled, gold, seed=seed), partition_by=["split"])
    return paths
