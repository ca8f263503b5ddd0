"""The SQL of the training-data queries on the test tables, at sf0.001."""

import os

import pytest
from oracle_compare import compare, duck

from landroll.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("LANDROLL_ORACLE_SF", "/root/testdata/sf0.001")


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_sql(spark, key):
    problems, _, _ = compare(spark, duck(SF_DIR), key, QUERIES[key], ORACLES[key], SF_DIR)
    assert not problems, problems
