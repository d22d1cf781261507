"""The queries on streams over tables that are folders of files."""

from pathlib import Path

import pytest
from oracle import TABLES

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    """The given tables, but conversations and events as folders of three files."""
    out = tmp_path_factory.mktemp("folders")
    for name in TABLES.split():
        if name in ("conversations", "events"):
            spark.read.parquet(f"{SF}/{name}.parquet").repartition(3).write.parquet(f"{out}/{name}.parquet")
        else:
            Path(f"{out}/{name}.parquet").symlink_to(f"{SF}/{name}.parquet")
    return str(out)


@pytest.mark.parametrize("name", ["X3_stream_triage", "X4_stream_pairs", "X5_windowed_counts"])
def test_tables_of_several_files(spark, folders, name):
    run = entry.queries()[name]
    assert sorted(run(spark, folders).collect()) == sorted(run(spark, SF).collect())
