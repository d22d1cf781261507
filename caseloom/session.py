"""Session set-up for tests and the benchmark, and the shared folder of a cluster."""

from __future__ import annotations

import re
import tempfile
from uuid import uuid4

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = "*", memory: str = "8g", partitions: int | None = None) -> SparkSession:
    """Session on this machine.  On a cluster use the one that is given."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("caseloom")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
    )
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_folder(spark)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder that all executors reach, as named in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(named)
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors reach")
    folder = tempfile.mkdtemp(prefix="caseloom-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path that tasks open without Spark, of a path as Hadoop or Spark writes it."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri))


def remove_folder(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


class Stores:
    """``keep`` writes like :func:`store`; ``remove`` deletes what was written, when nothing reads it any more."""

    def __init__(self) -> None:
        self.paths: list[tuple[SparkSession, str]] = []

    def keep(self, df: DataFrame) -> DataFrame:
        spark = df.sparkSession
        path = f"{shared_folder(spark)}/caseloom/table-{uuid4().hex}"
        self.paths.append((spark, path))
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    def remove(self) -> None:
        while self.paths:
            remove_folder(*self.paths.pop())


def store(df: DataFrame) -> DataFrame:
    """Write an intermediate result to the shared folder and go on from the written table.

    Cuts the lineage, survives the loss of executors, and gives the planner real sizes.
    """
    return Stores().keep(df)
