"""Queries that SQL can express match DuckDB over whole tables."""

import pytest

from tests.compare import compare
from tests.conftest import SF01
from txflow.llm.queries import QUERIES, SQL


def test_the_others_are_tested_against_brute_force():
    assert set(QUERIES) - set(SQL) == {"op2_packing", "op3_simhash", "op5_lattice", "op6_pii", "op7_bpe", "op9_language",
                                       "op10_secrets", "op12_lm_scoring", "op13_conversations"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, name):
    ok, msg = compare(spark, SF01, name, QUERIES[name], SQL[name])
    assert ok, msg
