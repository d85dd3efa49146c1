"""All registered queries against DuckDB, at the smallest scale."""

from pathlib import Path

import pytest

from oracle import compare
from tidegate.catalog import QUERIES
from tidegate.oracles import oracle_queries

SF_DIR = "/root/testdata/sf0.001"
ORACLES = oracle_queries()

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="needs the test tables")


def test_every_query_has_its_counterpart():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    compare(spark, QUERIES[name], ORACLES[name], SF_DIR)
