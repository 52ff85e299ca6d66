import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from abacist.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(8, shuffle_partitions=4, app="abacist-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """Small literal DataFrame: frame([(1, 'a')], 'k int, v string')."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)
