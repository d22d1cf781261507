"""Readers.  Schemas are given, never inferred."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom import schemas
from caseloom.functions.jsonparse import is_object

CSV = {"quote": '"', "escape": '"', "multiLine": "true"}


def csv_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, block, number, record``: the records of CSV files as texts, line ends in quotes included.

    Files are read in byte ranges (blocks), however large they are.  A line begins a record if
    the quotes before it are even in number: those of the blocks before, counted first, and
    those of the lines before it in its own block.  A record that goes on over the end of a
    block is put together from the last lines of one and the first lines of the next.
    ``block, number`` are where a record begins.  Quotes within a field have to be doubled and
    the field quoted, as all writers of CSV do.
    """
    at = F.col("_metadata")
    lines = spark.read.option("lineSep", "\n").text(path).select(
        at["file_path"].alias("file"), at["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("line"), "value"
    )
    lines = lines.withColumn("quotes", F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit(""))))
    blocks = lines.groupBy("file", "block").agg(F.sum("quotes").alias("quotes"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)).alias("earlier"))

    block = Window.partitionBy("file", "block")
    so_far = block.orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    placed = lines.join(blocks, ["file", "block"]).withColumn("open", (F.col("earlier") + F.coalesce(F.sum("quotes").over(so_far), F.lit(0))) % 2)
    up_to = block.orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumn("number", F.sum(1 - F.col("open")).over(up_to)).withColumn("last", F.sum(1 - F.col("open")).over(block))
    texts = F.transform(F.array_sort(F.collect_list(F.struct("line", "value"))), lambda x: x["value"])
    parts = placed.groupBy("file", "block", "number", "last").agg(F.array_join(texts, "\n").alias("record"))

    whole = parts.where("number > 0 AND number < last").select("file", "block", "number", "record")
    order = Window.partitionBy("file").orderBy("block", "number").rowsBetween(Window.unboundedPreceding, 0)
    edges = parts.where("number = 0 OR number = last").withColumn("chain", F.sum(F.when(F.col("number") > 0, 1).otherwise(0)).over(order))
    piece = F.array_sort(F.collect_list(F.struct("block", "number", "record")))
    joined = edges.groupBy("file", "chain").agg(piece.alias("p"))
    joined = joined.select("file", F.col("p")[0]["block"].alias("block"), F.col("p")[0]["number"].alias("number"), F.array_join(F.col("p.record"), "\n").alias("record"))
    return whole.unionByName(joined)


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = schemas.TWEETS,
    encoding: str = "UTF-8",
    keep_empty: bool = False,
) -> DataFrame:
    """CSV with a header and quoted texts over several lines; a file of any size is read by many tasks.

    ``keep_empty`` leaves no NULL in string columns.  ``encoding`` is one in which quotes, commas
    and line ends are the bytes of ASCII.
    """
    records = csv_records(spark, path).where("block > 0 OR number > 1")  # a file's first record is its header
    text = F.col("record") if encoding == "UTF-8" else F.decode(F.col("record").cast("binary"), encoding)
    parsed = records.select(F.regexp_replace(text, "\r\\z", "").alias("text")).where("text <> ''").select(F.from_csv("text", schema.toDDL(), CSV).alias("r"))
    df = parsed.select("r.*")
    if keep_empty:
        return df.na.fill("", subset=[f.name for f in schema.fields if isinstance(f.dataType, T.StringType)])
    return df


def read_csv_any_encoding(spark: SparkSession, path: str, schema: T.StructType = schemas.TWEETS) -> DataFrame:
    """Each file as UTF-8 if its bytes are that, else as Latin-1.

    The bytes are tested line by line, so a file may be as large as a disk, and a genuine
    replacement character in a text does not matter.
    """
    lines = spark.read.option("lineSep", "\n").text(path)  # keeps the bytes as they are
    tested = lines.select(F.input_file_name().alias("file"), F.is_valid_utf8("value").alias("fine"))
    files = tested.groupBy("file").agg(F.min("fine").alias("fine")).collect()  # one row per file
    kinds = {"UTF-8": [f["file"] for f in files if f["fine"]], "ISO-8859-1": [f["file"] for f in files if not f["fine"]]}
    parts = [read_csv(spark, names, schema, encoding) for encoding, names in kinds.items() if names]
    return reduce(DataFrame.unionByName, parts) if parts else read_csv(spark, path, schema)


def find_files(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """Files below a folder with their size, largest first."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    return files.select("path", "length").orderBy(F.desc("length"), "path")


def largest_file(spark: SparkSession, folder: str, pattern: str = "*.csv") -> str | None:
    row = find_files(spark, folder, pattern).first()
    return row["path"] if row else None


def _json_steps(value: Column) -> dict[str, Column]:
    """What a piece of JSON does: its quotes, and how much deeper it leads if it begins outside of a string or inside."""
    runs = F.split(F.regexp_replace(value, r"(?s)\\.", ""), '"')

    def deeper(first: int) -> Column:
        outside = F.array_join(F.filter(runs, lambda _, i: i % 2 == first), "")
        opened = F.length(F.regexp_replace(outside, r"[^\[{]", ""))
        return opened - F.length(F.regexp_replace(outside, r"[^\]}]", ""))

    return {"quotes": F.size(runs) - 1, "deep0": deeper(0), "deep1": deeper(1)}


def json_elements(spark: SparkSession, path: str | list[str], member: str = "samples") -> DataFrame:
    """``file, position, item``: the elements of JSON documents that are an array, or an object whose ``member`` is one.

    A document of any size, on one line or many, is read in byte ranges (blocks) and cut at
    its commas into pieces.  The quotes before a piece tell whether it begins inside a string,
    the brackets outside of strings how deep it lies; both are summed over blocks first and
    then over the pieces of a block.  An element ends at a comma as deep as the array itself,
    and its pieces are put together by its number.  ``item`` is a variant.

    A document gives no row if it is of neither kind, if a bracket or string is left open, or
    if one of its elements is no JSON.  Other members of an object are not looked into.
    """
    at = F.col("_metadata")
    pieces = spark.read.option("lineSep", ",").text(path).select(
        at["file_path"].alias("file"), at["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("line"), "value"
    )
    in_block = Window.partitionBy("file", "block").orderBy("line")
    so_far, up_to = (in_block.rowsBetween(Window.unboundedPreceding, end) for end in (-1, 0))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")

    def before(column: str) -> Column:
        return F.coalesce(F.sum(column).over(earlier), F.lit(0))

    pieces = pieces.withColumns(_json_steps(F.col("value")))
    pieces = pieces.withColumn("odd", F.coalesce(F.sum("quotes").over(so_far), F.lit(0)) % 2)
    by_start = [F.sum(F.when(F.col("odd") == begun, F.col("deep0")).otherwise(F.col("deep1"))).alias(f"d{begun}") for begun in (0, 1)]
    root = F.min_by(F.regexp_extract("value", r"^\s*(\S)", 1), "line").alias("root")
    blocks = pieces.groupBy("file", "block").agg(F.sum("quotes").alias("q"), *by_start, root)
    blocks = blocks.withColumn("begun", before("q") % 2)
    blocks = blocks.withColumn("d", F.when(F.col("begun") == 0, F.col("d0")).otherwise(F.col("d1")))
    blocks = blocks.select(
        "file",
        "block",
        "begun",
        before("d").alias("depth"),
        F.min_by("root", "block").over(whole).alias("root"),
        (F.sum("d").over(whole) == 0).alias("closed"),
        (F.sum("q").over(whole) % 2 == 0).alias("ended"),
    )
    placed = pieces.join(blocks.where("closed AND ended AND root IN ('[', '{')"), ["file", "block"])

    odd = (F.col("odd") + F.col("begun")) % 2
    placed = placed.withColumn("deep", F.when(odd == 0, F.col("deep0")).otherwise(F.col("deep1")))
    placed = placed.withColumn("level", F.col("depth") + F.sum("deep").over(up_to))
    outside = (odd + F.col("quotes")) % 2 == 0
    is_object = F.col("root") == "{"
    placed = placed.select(
        "file",
        "block",
        "line",
        "value",
        "root",
        "level",
        (outside & (F.col("level") <= F.when(is_object, 2).otherwise(1))).cast("int").alias("ends"),
        (outside & is_object & (F.col("level") <= 1)).cast("int").alias("ends_member"),
    )
    counts = placed.groupBy("file", "block").agg(F.sum("ends").alias("e"), F.sum("ends_member").alias("m"))
    counts = counts.select("file", "block", before("e").alias("e"), before("m").alias("m"))
    numbered = placed.join(counts, ["file", "block"])
    numbered = numbered.withColumn("number", F.col("e") + F.sum("ends").over(up_to) - F.col("ends"))
    numbered = numbered.withColumn("member", F.col("m") + F.sum("ends_member").over(up_to) - F.col("ends_member"))
    texts = F.transform(F.array_sort(F.collect_list(F.struct("block", "line", "value"))), lambda x: x["value"])
    level = F.max_by("level", F.struct("block", "line")).alias("level")
    elements = numbered.groupBy("file", "root", "member", "number").agg(F.array_join(texts, ",").alias("text"), level)

    # the first member of that name that holds an array; a document that is an array has one member
    opening = F.when(F.col("root") == "[", F.lit(r"^\s*\[")).otherwise(F.lit(rf'^\s*\{{?\s*"{re.escape(member)}"\s*:\s*\['))
    heads = elements.groupBy("file", "member").agg(F.min(F.struct("number", F.rlike("text", opening).alias("opens"))).alias("h"))
    heads = heads.where("h.opens").groupBy("file").agg(F.min(F.struct("member", "h.number")).alias("h")).select("file", "h.member", F.col("h.number").alias("head"))
    held = elements.join(heads, ["file", "member"]).withColumn("position", (F.col("number") - F.col("head")).cast("int"))
    body = F.when(F.col("position") == 0, F.regexp_replace("text", opening, F.lit(""))).otherwise(F.col("text"))
    array_level = F.when(F.col("root") == "{", 2).otherwise(1)
    closing = F.when(F.col("level") == 0, F.when(F.col("root") == "{", F.lit(r"\]\s*\}\s*\z")).otherwise(F.lit(r"\]\s*\z"))).otherwise(F.lit(r"\]\s*\z"))
    last = F.col("level") < array_level
    held = held.withColumn("body", F.when(last, F.regexp_replace(body, closing, F.lit(""))).otherwise(body))
    held = held.where(~(last & (F.col("position") == 0) & F.rlike("body", F.lit(r"^\s*\z"))))  # an empty array
    items = held.select("file", "position", F.try_parse_json("body").alias("item"))
    broken = items.where("item IS NULL").select("file").distinct()
    return items.join(broken, "file", "left_anti")


def read_sample_messages(spark: SparkSession, path: str) -> DataFrame:
    """Messages of JSON documents: a list, or an object with ``samples``; items are texts or objects."""
    rows = json_elements(spark, path)
    fields = F.when(is_object(F.col("item")), F.col("item"))
    text = F.coalesce(
        F.nullif(F.try_variant_get(fields, "$.message", "string"), F.lit("")),
        F.nullif(F.try_variant_get(fields, "$.customer_message", "string"), F.lit("")),
        F.when(fields.isNull(), F.try_variant_get("item", "$", "string")),
        F.lit(""),
    )
    return rows.select("file", "position", text.alias("message"))


def read_fields(spark: SparkSession, path: str) -> DataFrame:
    """``Key: value`` lines as rows."""
    lines = spark.read.text(path).where(F.contains("value", F.lit(":")))
    parts = F.split("value", ":", 2)
    return lines.select(F.trim(parts[0]).alias("key"), F.trim(parts[1]).alias("value"))


def read_field(spark: SparkSession, path: str, key: str) -> str | None:
    row = read_fields(spark, path).where(F.col("key") == key).first()
    return row["value"] if row else None


def read_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON documents of a saved report."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def selected_brand(spark: SparkSession, path: str) -> str | None:
    """The brand that a summary names, be it a JSON report or ``Selected brand: …`` lines."""
    row = read_report(spark, path, T.StructType().add("selected_brand", "string")).where("selected_brand IS NOT NULL").first()
    return row["selected_brand"] if row else read_field(spark, path, "Selected brand")


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame | None:
    """Parquet table, or None if it is missing or lacks one of ``columns``."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException:
        return None
    return None if columns and not set(columns) <= set(df.columns) else df
