import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from chaintally.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", shuffle_partitions=4, extra={
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="chaintally-test-ck-", dir="/tmp"),
        "spark.driver.memory": "4g",
    })
    yield session
    session.stop()


@pytest.fixture
def lines(spark):
    """Build a line collection from Python strings."""
    def make(rows, partitions=2):
        return spark.createDataFrame([(r,) for r in rows], "value string").repartition(partitions)
    return make
