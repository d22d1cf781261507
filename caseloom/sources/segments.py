"""A retrieval index of segments: new cases are appended, and a merge makes few segments of many.

A segment holds what its cases are by themselves: the first case of each message, all
replies, the counts of their terms, and for each term its frequency and in how many of the
segment's messages it is.  Weights are made when the index is opened, from the sums over
all segments, since every new case changes the document frequencies.  So old cases are
never read or tokenized again, and the opened index is that of all cases together.

A version, written last, lists the segments that count; a failed append leaves no trace in
it, and of two writers that make the same version one fails.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom import config
from caseloom.operators import similarity as S
from caseloom.session import store
from caseloom.sources.readers import read_table


def _versions(spark: SparkSession, path: str) -> DataFrame | None:
    return read_table(spark, f"{path}/versions", ["segment", "version"])


def segments(spark: SparkSession, path: str) -> list[str]:
    """Names of the segments of the newest version."""
    versions = _versions(spark, path)
    if versions is None:
        return []
    newest = versions.where(F.col("version") == versions.agg(F.max("version")).scalar())
    return sorted(r["segment"] for r in newest.select("segment").collect())


def _publish(spark: SparkSession, path: str, names: list[str]) -> None:
    versions = _versions(spark, path)
    last = 0 if versions is None else versions.agg(F.max("version").alias("v")).first()["v"]
    listed = spark.createDataFrame([(n,) for n in names], "segment string").coalesce(1)
    listed.write.mode("error").parquet(f"{path}/versions/version={last + 1}")


def _stop_words(spark: SparkSession, path: str) -> tuple:
    return tuple(r["word"] for r in spark.read.parquet(f"{path}/stop_words").orderBy("word").collect())


def _read(spark: SparkSession, path: str, table: str, names: list[str]) -> DataFrame:
    """A table of the named segments, each row with its segment."""
    return spark.read.option("basePath", f"{path}/{table}").parquet(*[f"{path}/{table}/segment={n}" for n in names]).withColumn(
        "segment", F.col("segment").cast("string")
    )


def _write(spark: SparkSession, path: str, firsts: DataFrame, replies: DataFrame, counts: DataFrame) -> str:
    name = f"s{uuid4().hex}"
    firsts.write.parquet(f"{path}/firsts/segment={name}")
    replies.write.parquet(f"{path}/replies/segment={name}")
    counts.write.parquet(f"{path}/counts/segment={name}")
    written = spark.read.schema(counts.schema).parquet(f"{path}/counts/segment={name}")
    _per_term(written).write.parquet(f"{path}/terms/segment={name}")
    return name


def _per_term(counts: DataFrame) -> DataFrame:
    return counts.groupBy("term").agg(F.sum("tf").alias("frequency"), F.count(F.lit(1)).alias("df"))


def append(path: str, cases: DataFrame, stop_words=None, order: str = "brand_tweet_id") -> str:
    """Write the cases as another segment; its name.  The first segment decides the stop words.

    All segments need the same columns.  A message may be in several segments, with other replies.
    """
    spark = cases.sparkSession
    names = segments(spark, path)
    if not names:
        words = S.default_stop_words() if stop_words is None else stop_words
        spark.createDataFrame([(w,) for w in words], "word string").coalesce(1).write.mode("overwrite").parquet(f"{path}/stop_words")
    filled = S.fill_cases(cases)
    firsts = store(S.first_cases(filled, order))
    counts = S.term_counts(S.unpacked(firsts), "doc_id", "customer_message", _stop_words(spark, path))
    name = _write(spark, path, firsts, S.replies_of(filled, order), counts)
    _publish(spark, path, [*names, name])
    return name


def _joined(spark: SparkSession, path: str, names: list[str]) -> tuple[DataFrame, DataFrame]:
    """Firsts over the segments, with the segment each comes from, and the ``(segment, doc_id)`` that others replace."""
    every = _read(spark, path, "firsts", names)
    firsts = every.groupBy("doc_id").agg(
        F.min(F.struct("first", "segment")).alias("w"), F.sum("n_replies").alias("n_replies"), F.count(F.lit(1)).alias("n")
    )
    again = firsts.where("n > 1").select("doc_id", F.col("w.segment").alias("kept"))
    replaced = every.select("segment", "doc_id").join(again, "doc_id").where("segment <> kept").select("segment", "doc_id")
    return firsts.select("doc_id", F.col("w.first").alias("first"), "n_replies"), replaced


def open_index(
    spark: SparkSession, path: str, max_features: int = config.DEFAULT.max_features, keep: Callable[[DataFrame], DataFrame] = store
) -> S.CaseIndex | None:
    """The index of all cases of the newest version, or None if there is none."""
    names = segments(spark, path)
    if not names:
        return None
    firsts, replaced = _joined(spark, path, names)
    grouped, replaced = keep(S.unpacked(firsts)), keep(replaced)
    every = _read(spark, path, "counts", names)
    # the sums of the segments, less what is counted for messages that another segment has earlier
    less = _per_term(every.join(replaced, ["segment", "doc_id"], "left_semi"))
    parts = _read(spark, path, "terms", names).select("term", "frequency", "df")
    parts = parts.unionByName(less.select("term", (-F.col("frequency")).alias("frequency"), (-F.col("df")).alias("df")))
    terms = parts.groupBy("term").agg(F.sum("frequency").alias("frequency"), F.sum("df").alias("df")).where("df > 0")
    vocab = keep(S.most_frequent(terms, S.n_rows(grouped), max_features))
    counts = every.join(replaced, ["segment", "doc_id"], "left_anti").select("doc_id", "term", "tf")
    replies = _read(spark, path, "replies", names).drop("segment")
    return S.lay_out(grouped, replies, counts, vocab, _stop_words(spark, path), keep)


def merge(spark: SparkSession, path: str, names: list[str] | None = None) -> str:
    """One segment in place of the named ones, or of all; its name.  The old files stay for those who read them."""
    now = segments(spark, path)
    names = now if names is None else names
    if not names or not set(names) <= set(now):
        raise ValueError("only segments of the newest version can be merged")
    firsts, replaced = _joined(spark, path, names)
    counts = _read(spark, path, "counts", names).join(replaced, ["segment", "doc_id"], "left_anti").drop("segment")
    name = _write(spark, path, firsts, _read(spark, path, "replies", names).drop("segment"), counts)
    _publish(spark, path, [*(n for n in now if n not in names), name])
    return name
