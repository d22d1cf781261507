"""Writers.  A result always goes to a path of its own, never over its input."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from caseloom import config
from caseloom.operators import classify, similarity
from caseloom.sources.readers import read_table


def write_csv(df: DataFrame, path: str) -> str:
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Overwrite a parquet table; each partition value is written by several tasks if it is large."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    """One JSON object per row, NULL fields included."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path


def write_summary(df: DataFrame, path: str) -> str:
    """A one-row report as one JSON document."""
    write_json(df.limit(1).coalesce(1), path)
    return path


def write_twice(df: DataFrame, first: str, second: str) -> tuple[str, str]:
    """Write one result under two names, computing it once."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return write_parquet(kept, first), write_parquet(kept, second)
    finally:
        kept.unpersist()


PAGES = 64
TASKS_PER_PAGE = 8


def save_index(index: similarity.CaseIndex, path: str, pages: int = PAGES) -> str:
    """Write the tables of an index.  Those that are looked up lie in ``pages`` folders by the hash of their key.

    A page is written by several tasks, so a hot term's postings are not one task's.
    """
    spark = index.cases.sparkSession
    for name in index.TABLES:
        df = getattr(index, name)
        if name in index.PAGED:
            part = F.pmod(F.xxhash64(*[c for c in ("doc_id", "vec_id") if c in df.columns], F.lit(1)), F.lit(TASKS_PER_PAGE))
            paged = df.withColumn("page", similarity.page_of(index.PAGED[name], pages))
            write_parquet(paged.repartition("page", part), f"{path}/{name}", ["page"])
        else:
            write_parquet(df.repartition("doc_id") if name == "replies" else df, f"{path}/{name}")
    write_parquet(spark.createDataFrame([(pages,)], "pages int"), f"{path}/layout")
    write_parquet(spark.createDataFrame([(w,) for w in index.stop_words], "word string"), f"{path}/stop_words")
    return path


def load_index(spark: SparkSession, path: str) -> similarity.CaseIndex | None:
    """Index at a path, or None if it is missing or of an older layout."""
    wanted = {
        "cases": ["doc_id", "customer_message", "n_replies"],
        "replies": ["doc_id", "reply_order", "brand_reply"],
        "vocab": ["term", "idf"],
        "members": ["doc_id", "vec_id"],
        "postings": ["vec_id", "term", "weight", "df", "level"],
        "blocks": ["term", "level", "top", "n"],
        "layout": ["pages"],
    }
    tables = {name: read_table(spark, f"{path}/{name}", columns) for name, columns in wanted.items()}
    words = read_table(spark, f"{path}/stop_words", ["word"])
    if words is None or any(t is None for t in tables.values()):
        return None
    pages = tables.pop("layout").first()["pages"]
    tables = {name: _with_pages(t) if name in similarity.CaseIndex.PAGED else t for name, t in tables.items()}
    return similarity.CaseIndex(**tables, stop_words=tuple(r["word"] for r in words.orderBy("word").collect()), pages=pages)


def _with_pages(table: DataFrame) -> DataFrame:
    """An empty table has no folder of a page, and so no such column."""
    return table if "page" in table.columns else table.withColumn("page", F.lit(None).cast("int"))


def load_or_build_index(spark: SparkSession, path: str, cases: DataFrame, **options) -> similarity.CaseIndex:
    found = load_index(spark, path)
    if found is None:
        save_index(similarity.build_index(cases, **options), path)
        found = load_index(spark, path)
    return found


def save_classifier(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_or_fit_classifier(
    spark: SparkSession, path: str, train: DataFrame, cfg: config.TriageConfig = config.DEFAULT
) -> PipelineModel:
    if read_table(spark, f"{path}/stages/*/data") is None:
        save_classifier(classify.fit_classifier(train, cfg), path)
    return PipelineModel.load(path)


def brand_summary(selected: DataFrame) -> DataFrame:
    """Selected brand with its volume columns, as written by ``write_summary``."""
    return selected.select(
        F.col("brand").alias("selected_brand"), "tweets", "customer_tweets", "brand_replies", "conversations"
    )
