"""Table profiles and quality reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.functions import text as X
from caseloom.operators.cases import is_inbound

# Column-name fragments of each role.
ROLE_FRAGMENTS = {
    "brand": ("brand", "company", "account", "author"),
    "reply": ("reply", "conversation", "in_response"),
    "time": ("time", "date", "created"),
}


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, and the number of rows of the table."""
    described = F.explode(
        F.array(
            *[
                F.struct(F.lit(i).alias("position"), F.lit(n).alias("column_name"), F.lit(t).alias("data_type"))
                for i, (n, t) in enumerate(df.dtypes, start=1)
            ]
        )
    )
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(described.alias("c"), "n_rows").select("c.*", "n_rows")


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values per column, all columns in one pass."""
    one_row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return one_row.unpivot([], list(df.columns), "column_name", "missing")


def _narrow(df: DataFrame) -> list[Column]:
    # Texts are compared by digest: the shuffle carries 32 bytes instead of the text.
    return [
        F.unhex(F.sha2(F.col(f.name), 256)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema.fields
    ]


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Number of rows equal to an earlier one; NULLs compare equal."""
    narrow = df.select(*_narrow(df))
    sizes = narrow.groupBy(*narrow.columns).agg(F.count(F.lit(1)).alias("_n"))
    return sizes.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))


def message_quality(tweets: DataFrame, short: int = 2, long: int = 300) -> DataFrame:
    """One-row message quality report; nothing is removed.

    The defect flags are counted per group of identical rows, so the duplicate count
    needs no second pass.
    """
    length = F.length("text")
    flagged = tweets.select(
        *_narrow(tweets),
        F.col("text").isNull().alias("_no_text"),
        X.parse_when("created_at").isNull().alias("_no_time"),
        F.coalesce(length < short, F.lit(False)).alias("_short"),
        F.coalesce(length > long, F.lit(False)).alias("_long"),
        F.col("in_response_to_tweet_id").isNull().alias("_no_link"),
        is_inbound(tweets).isNull().alias("_odd_inbound"),
    )
    flags = [c for c in flagged.columns if c.startswith("_")]
    groups = flagged.groupBy(*flagged.columns).agg(F.count(F.lit(1)).alias("n"))

    def total(flag):
        return F.coalesce(F.sum(F.when(F.col(flag), F.col("n"))), F.lit(0))

    names = {
        "_no_text": "missing_text",
        "_no_time": "invalid_timestamps",
        "_short": "short_messages",
        "_long": "long_messages",
        "_no_link": "missing_reply_link",
        "_odd_inbound": "unexpected_inbound",
    }
    return groups.agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"), *[total(f).alias(names[f]) for f in flags]
    )


def unexpected_inbound(tweets: DataFrame) -> DataFrame:
    """Rows whose direction flag is neither true nor false."""
    return tweets.where(is_inbound(tweets).isNull())


def column_roles(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Columns that look like a brand, a reply link or a time, from their names."""
    found = [
        (role, c) for role, parts in ROLE_FRAGMENTS.items() for c in df.columns if any(p in c.lower() for p in parts)
    ]
    return spark.createDataFrame(found, "role string, column_name string")


def head_and_tail(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """First and last ``n`` rows in key order."""
    head = df.orderBy(*order).limit(n).withColumn("part", F.lit("head"))
    tail = df.orderBy(*[F.desc(c) for c in order]).limit(n).withColumn("part", F.lit("tail"))
    return head.unionByName(tail)


def date_range(df: DataFrame, column: str = "created_at") -> DataFrame:
    """Earliest and latest parseable creation time, as seconds since the epoch."""
    when = F.unix_seconds(X.parse_when(column))
    return df.agg(F.min(when).alias("first_second"), F.max(when).alias("last_second"))


def direction_counts(tweets: DataFrame) -> DataFrame:
    return tweets.groupBy("inbound").agg(F.count(F.lit(1)).alias("n"))


def length_counts(df: DataFrame, column: str = "text") -> DataFrame:
    """Number of texts of each length: the small table behind the length statistics."""
    lengths = df.where(F.col(column).isNotNull()).select(F.length(column).alias("chars"))
    return lengths.groupBy("chars").agg(F.count(F.lit(1)).alias("n"))


def length_statistics(df: DataFrame, column: str = "text") -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum of text length."""
    n, x = F.col("n").cast("decimal(38,0)"), F.col("chars")
    summed = length_counts(df, column).agg(
        F.sum("n").alias("n"),
        F.sum(n * x).alias("s"),
        F.sum(n * x * x).alias("q"),
        F.min("chars").alias("min_chars"),
        F.expr("percentile(chars, array(0.25, 0.5, 0.75), n)").alias("p"),
        F.max("chars").alias("max_chars"),
    )
    s, q = F.col("s").cast("double"), F.col("q").cast("double")
    centred = q - s * s / F.col("n")
    return summed.select(
        F.col("n").alias("n_texts"),
        (s / F.col("n")).alias("mean_chars"),
        F.when(F.col("n") > 1, F.sqrt(F.greatest(centred, F.lit(0.0)) / (F.col("n") - 1))).alias("std_chars"),
        "min_chars",
        F.get("p", F.lit(0)).alias("p25"),
        F.get("p", F.lit(1)).alias("p50"),
        F.get("p", F.lit(2)).alias("p75"),
        "max_chars",
    )


def length_histogram(df: DataFrame, column: str = "text", bins: int = 50) -> DataFrame:
    """Counts in equal-width bins; empty bins are kept."""
    counts = length_counts(df, column)
    edges = counts.agg(F.min("chars").alias("lo"), F.max("chars").alias("hi"))
    lo, hi = edges.select("lo").scalar(), edges.select("hi").scalar()
    width = F.greatest((hi - lo) / F.lit(float(bins)), F.lit(1e-9))
    bin_of = F.least(F.floor((F.col("chars") - lo) / width), F.lit(bins - 1)).alias("bin")
    filled = counts.groupBy(bin_of).agg(F.sum("n").alias("n"))
    every = edges.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long"))).alias("bin"))
    return every.join(filled, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows and percentage per value."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("percentage", F.col("n") * F.lit(100.0) / F.sum("n").over(Window.partitionBy(F.lit(0))))
