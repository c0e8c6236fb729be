"""Every registered query against its DuckDB oracle SQL (exact value match)."""

import pytest
from conftest import SF_SMALL
from oracle_compare import compare, duck

from svcvitals.plans.oracle import ORACLE_SQL
from svcvitals.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLE_SQL[name], SF_SMALL)
    assert r["cols_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["spark_rows"] > 0, r
    assert r["exact"], r


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())
