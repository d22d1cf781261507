"""Helpers for Arrow batches inside tasks and for tables between jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

BATCH_BYTES = 4 << 20
#: What operators keep in a worker process from task to task, by name, with the way to let it go.
CACHES: dict[str, Callable[[], None]] = {}


def small_batches(spark: SparkSession) -> None:
    """Sets the session's Arrow batches to what whole texts ask for: 10,000 rows of them, the default,
    would be held by the executor, by the worker and once more on the way back."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1000)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = BATCH_BYTES, using: str = "") -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most about ``most`` bytes of ``column`` (at least one row each).

    Worker processes serve one operator after another; the caches of all but the one in
    use are let go, so that they do not add up.
    """
    for name, clear in CACHES.items():
        if name != using:
            clear()
    for batch in batches:
        mean = max(1, batch.column(column).nbytes // max(1, batch.num_rows))
        step = max(1, most // mean)
        for lo in range(0, batch.num_rows, step):
            yield batch.slice(lo, step)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table], schema: str | StructType, column: str, using: str = "") -> DataFrame:
    """``mapInArrow`` in slices of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, column, using=using):
            yield from as_batches(fn(part))

    return df.mapInArrow(run, schema)


def as_batches(made: pa.RecordBatch | pa.Table) -> list[pa.RecordBatch]:
    return made.to_batches() if isinstance(made, pa.Table) else [made]


def add_columns(df: DataFrame, fn: Callable[[pa.RecordBatch], list[pa.Array]], added: str, column: str, keep_text: bool = True, using: str = "") -> DataFrame:
    """``df`` with the columns ``fn`` makes of each batch, in place of any of the same names.

    Without ``keep_text``, ``column`` itself is not handed back.
    """
    new = _parse_datatype_string(added)
    rest = df.drop(*new.names)
    kept = [c for c in rest.columns if keep_text or c != column]
    schema = StructType([rest.schema[c] for c in kept] + new.fields)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        arrays = [batch.column(c) for c in kept] + fn(batch)
        return pa.RecordBatch.from_arrays(arrays, kept + new.names)

    return map_batches(rest, run, schema, column, using)


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the key and the text, under the names the operators use."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def cores(df: DataFrame) -> int:
    return max(2, df.sparkSession.sparkContext.defaultParallelism)
