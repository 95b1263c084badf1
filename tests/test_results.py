"""Every registered query against plain SQL on another engine, value by value."""

import pytest

duckdb = pytest.importorskip("duckdb")

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from check_results import compare, engine  # noqa: E402
from spendecho.plans.queries import REGISTRY  # noqa: E402

NAMES = sorted(queries())
WITH_SQL = sorted(set(NAMES) & set(oracle_sql()))


@pytest.fixture(scope="module")
def con(sf_dir):
    return engine(sf_dir)


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(NAMES)
    assert set(REGISTRY) <= set(oracle_sql())


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_matches_sql(spark, con, sf_dir, name):
    mine = queries()[name](spark, sf_dir).toArrow()
    assert compare(mine, con.sql(oracle_sql()[name]).to_arrow_table()) is None


def test_entry(spark):
    df = entry(spark)
    assert df.columns[:3] == ["surrogate_key", "date", "channel"] and df.count() > 0
