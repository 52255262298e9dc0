"""The queries of this subpackage that SQL can express, against that SQL."""

import os
import sys

import pytest

from .conftest import SF01

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from trackmart.llm.queries import QUERIES, SQL  # noqa: E402


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    from oracle import compare, duck
    ok, msg = compare(spark, duck(SF01), name, QUERIES[name], SQL[name], SF01)
    assert ok, msg
