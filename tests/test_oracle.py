"""Every registered query against its SQL, at a small scale factor (``TEST_SF`` to change it)."""

import os

import pytest

from tests.oracle import TESTDATA, compare, connect
from tracewarden.catalog.all_queries import ORACLES, QUERIES

SF_DIR = f"{TESTDATA}/sf{os.environ.get('TEST_SF', '0.001')}"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, SF_DIR, name, QUERIES, ORACLES) is None


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
