import os
import tempfile

import pytest

from medalake.session import local_session


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="medalake-warehouse-")
    session = local_session(
        8, app="tests", shuffle_partitions="4", driver_memory="6g",
        **{"spark.sql.warehouse.dir": warehouse},
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    path = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(path):
        pytest.skip("test tables are not here")
    return path


@pytest.fixture
def shuffle_partitions(spark):
    """Set the shuffle partitions for one test."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    yield lambda n: spark.conf.set(name, str(n))
    spark.conf.set(name, before)
