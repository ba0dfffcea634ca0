"""Every registered query against its DuckDB oracle on the smallest tables."""

from __future__ import annotations

import os

import pytest
from oracle import compare

import __spark_entry__ as entry
from tallyrule.plans import merchant_queries, table_queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.mark.parametrize("name", sorted({**table_queries.QUERIES, **merchant_queries.QUERIES}))
def test_query_matches_oracle(spark, name):
    q = entry.queries()[name]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert q(spark, SF).count() >= 0
        return
    ok, msg = compare(spark, name, q, sql, SF)
    assert ok, msg
    # an empty result would match an empty oracle and prove nothing
    assert not msg.startswith("0 rows"), name


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["p_type", "brands_part", "p_type_count", "brands_part_count"]
    assert df.count() > 0
