"""A ledger of provider answers: what was answered is not asked, and not paid for, again."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import reduce
from uuid import uuid4

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.operators.replies import ReplyBatch, answer
from caseloom.session import file_system, remove_folder, store
from caseloom.sources.readers import read_table

COLUMNS = ("digest", "raw", "error")
SCHEMA = "digest string, raw string, error string"
PROMPTS_PER_FILE = 100


def ask_once(
    df: DataFrame,
    prompt: str,
    provider: ReplyBatch,
    ledger: str,
    out: str = "generated",
    prompts_per_file: int = PROMPTS_PER_FILE,
    keep: Callable[[DataFrame], DataFrame] = store,
) -> DataFrame:
    """Add ``struct<raw, error>`` from a batch callable, which sees a prompt only if the folder ``ledger`` has no answer.

    Equal prompts are asked once.  The open prompts are written first, so a task that is
    repeated gets the same ones in the same order; it writes the answers of each slice of
    ``prompts_per_file`` prompts as they come and reads back the slices that an earlier
    attempt, on whatever executor, has written.  At most one slice for each lost task is asked again
    (two attempts that run at the same time, by speculation, do not see each other's).  A run
    that fails altogether leaves its slices for the next one.  Errors are returned, but the
    next run asks those prompts again.  A NULL prompt is not asked and has neither reply nor error.
    """
    spark = df.sparkSession
    rows = keep(df.withColumn("_digest", F.sha2(F.col(prompt), 256)))
    asked = rows.where(F.col("_digest").isNotNull()).groupBy("_digest").agg(F.any_value(prompt).alias("_prompt"))
    known = _answered(spark, ledger)
    if known is not None:
        asked = asked.join(known.select(F.col("digest").alias("_digest")), "_digest", "left_anti")
    slices = f"{ledger}/slices/{uuid4().hex}"
    answers = keep(keep(asked).mapInArrow(recorded(provider, slices, prompts_per_file), SCHEMA))
    answers.where("error IS NULL").write.mode("append").parquet(f"{ledger}/answers")
    remove_folder(spark, slices)
    found = answers if known is None else answers.unionByName(known)
    found = found.select(F.col("digest").alias("_digest"), F.col("raw").alias("_raw"), F.col("error").alias("_error"))
    given = F.struct(F.col("_raw").alias("raw"), F.col("_error").alias("error")).alias(out)
    return rows.join(found, "_digest", "left").select(*df.columns, given)


def _answered(spark: SparkSession, ledger: str) -> DataFrame | None:
    """The successful answers of earlier runs, one for each prompt, also of runs that failed later."""
    tables = [read_table(spark, f"{ledger}/{part}", list(COLUMNS)) for part in ("answers", "slices/*")]
    tables = [t.select(*COLUMNS) for t in tables if t is not None]
    if not tables:
        return None
    every = reduce(DataFrame.unionByName, tables).where("error IS NULL")
    return every.groupBy("digest").agg(F.min("raw").alias("raw")).withColumn("error", F.lit(None).cast("string"))


def recorded(provider: ReplyBatch, folder: str, size: int):
    """Function for ``mapInArrow`` from ``(digest, prompt)`` to the ledger's columns, each slice by way of a file."""

    def run(batches):
        place, path = file_system(folder)
        place.create_dir(path, recursive=True)
        for batch in batches:
            for start in range(0, batch.num_rows, size):
                digests, prompts = (c.to_pylist() for c in batch.slice(start, size).columns)
                name = hashlib.sha256(" ".join(digests).encode()).hexdigest()
                file = f"{path}/{name}.parquet"
                if place.get_file_info(file).type == fs.FileType.NotFound:
                    raw, errors = answer(provider, prompts)
                    columns = [pa.array(c, pa.string()) for c in (digests, raw, errors)]
                    unseen = f"{path}/_{uuid4().hex}"  # readers skip names that begin so
                    pq.write_table(pa.table(columns, names=COLUMNS), unseen, filesystem=place)
                    place.move(unseen, file)
                yield from pq.read_table(file, filesystem=place).to_batches()

    return run
