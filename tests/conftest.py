import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from caseloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, partitions=2)
    # Compiling generated code takes longer than the few test rows.
    session.conf.set("spark.sql.codegen.wholeStage", "false")
    session.conf.set("spark.sql.codegen.factoryMode", "NO_CODEGEN")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """DataFrame from literal rows."""
    return lambda data, schema: spark.createDataFrame(data, schema)
