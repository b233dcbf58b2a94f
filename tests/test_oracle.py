"""Every registered query against its DuckDB oracle on the smallest data."""

import pytest

from small_data import SF_SMALL
from oracle_compare import ORDERED, compare, compare_order, duckdb_for
from stockflow.plans.oracle import ORACLE_SQL
from stockflow.plans.registry import QUERIES


@pytest.fixture(scope="module")
def con():
    return duckdb_for(SF_SMALL)


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), ORACLE_SQL[name], con, ORDERED.get(name))
    assert ok, msg


def test_a_lost_sort_is_noticed(con):
    sql = "SELECT * FROM (VALUES (1, 'a'), (2, 'b'), (NULL, 'c')) t(k, v)"
    order = "k DESC NULLS LAST"
    assert compare_order(["k", "v"], [(2, "b"), (1, "a"), (None, "c")], sql, order, con)[0]
    for rows in ([(1, "a"), (2, "b"), (None, "c")], [(None, "c"), (2, "b"), (1, "a")]):
        assert not compare_order(["k", "v"], rows, sql, order, con)[0]
