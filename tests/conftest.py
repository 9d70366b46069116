import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from lakeops.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    session = local_session(8, "8g", **{"spark.sql.warehouse.dir": warehouse})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def con():
    from check import connect

    return connect(SF)


@pytest.fixture
def schema(spark, request):
    """A fresh database, gone after the test."""
    name = f"t_{abs(hash(request.node.nodeid)) % 10**9}"
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")
