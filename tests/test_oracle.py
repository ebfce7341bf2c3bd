"""Every registered query with an oracle matches DuckDB at sf0.01."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import compare
from tests.conftest import SF01
from txflow.plans import QUERIES, SQL


def test_every_query_has_oracle_or_is_listed():
    assert set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql())
    no_oracle = set(QUERIES) - set(SQL)
    assert no_oracle == set()


def test_entry_smoke(spark):
    df = entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["category", "total_amount", "tx_count", "avg_check"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, name):
    ok, msg = compare(spark, SF01, name, QUERIES[name], SQL[name])
    assert ok, msg
