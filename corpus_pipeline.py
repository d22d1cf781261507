"""The corpus pipeline: documents to packed training sequences, in stages.

Every stage takes ``(spark, docs, sf_dir)`` and gives the DataFrame that the next one
reads, after it was written as Parquet.  All but the last keep the columns of documents.
"""

from __future__ import annotations

from uuid import uuid4

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm import language, packing, simhash, substring, toxicity
from caseloom.llm.batches import small_batches
from caseloom.llm.grams import crc_of_id
from caseloom.session import shared_folder


def _unused(docs: DataFrame, name: str) -> str:
    """The name, lengthened until no column of ``docs`` is called so."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without a letter go.

    Learns from two thirds of the documents that have a language.
    """
    model = language.fit(docs.where(crc_of_id(F.col("doc_id")) % 3 != 1))
    name, score = _unused(docs, "lang_pred"), _unused(docs, "lang_score")
    told = language.predict(docs, model, name=name, score=score)
    return told.where(F.col(name) != language.UNDETERMINED).select(*docs.columns)


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic; learns from the labels of three quarters of them."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(crc_of_id(F.col("doc_id")) % 4 != 2)
    name, score = _unused(docs, "toxic_pred"), _unused(docs, "toxic_score")
    rated = toxicity.score(docs, toxicity.fit(docs, labels), threshold=0.3, score_col=score, name=name)
    return rated.where(F.col(name) == 0).select(*docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of the SimHash operator: shingles of four words, links at four bits.

    That is the row with the smallest id; of several with that id the one whose columns hash
    lowest (128 bits), so that every run keeps the same.  Rows of equal id in different groups
    all stay.  A row without an id stays unless a near copy has one; of near copies that all
    have none, and of rows that are equal in all columns, one stays.
    """
    row = _unused(docs, "row")
    nulls = [F.col(c).isNull() for c in docs.columns]
    halves = [F.xxhash64(F.lit(i), *docs.columns, *nulls).alias(f"h{i}") for i in (1, 2)]
    keyed = docs.withColumn(row, F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), *halves))
    groups = simhash.near_duplicates(keyed, shingle=4, radius=4, id_col=row)
    firsts = groups.where("doc_id = component_id").select(F.col("doc_id").alias(row)).distinct()
    return keyed.join(firsts, row, "left_semi").dropDuplicates([row]).select(*docs.columns)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 words that documents with smaller ids have; emptied ones go.

    A text that loses words has its kept words joined by one space; n_chars follows.
    """
    rest = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    left = substring.remove_repeats(docs, window=50, carry=rest).where("n_removed < n_words OR n_words = 0")
    shown = F.length("text").cast(docs.schema["n_chars"].dataType)
    own = {c: F.col(f"rest.{c}") for c in rest} | {"doc_id": F.col("doc_id"), "text": F.col("text")}
    own["n_chars"] = F.when(F.col("n_removed") > 0, shown).otherwise(own["n_chars"])
    return left.select(*[own[c].alias(c) for c in docs.columns])


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document lies in sequences of 1024 tokens.

    After four other stages the executors' heaps are full, so the workers keep fewer pieces.
    """
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"), 1024, end_id=2, keep_ids=False, kept_pieces=100_000)


def _stage(fn):
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return fn(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("language", _stage(language_id)),
    ("toxicity", _stage(without_toxic)),
    ("near_duplicates", _stage(one_of_near_copies)),
    ("repeated_passages", _stage(without_repeats)),
    ("packing", _stage(packed_sequences)),
]
#: Trained models and whole-text fingerprints are beyond SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each one's result written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/caseloom/pipeline-{uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{i}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
