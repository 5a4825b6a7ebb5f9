"""The training-data queries that SQL can express, against their SQL."""

import pytest

from tests.oracle import TESTDATA, compare, connect
from tracewarden.llm.queries import ORACLES, QUERIES

SF_DIR = f"{TESTDATA}/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    assert compare(spark, connect(SF_DIR), SF_DIR, name, QUERIES, ORACLES) is None
