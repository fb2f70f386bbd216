"""Every query with SQL gives the rows DuckDB gives; every other one gives rows."""

import os

import pytest
from check_queries import DATA, compare, connect

import __spark_entry__ as entry
from tidegauge.plans.registry import QUERIES

FOLDER = f"{DATA}/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if q.sql is not None))
def test_query_matches_sql(spark, con, name):
    problem, _, types = compare(spark, con, name, FOLDER)
    assert problem is None
    assert types == ""


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if q.sql is None))
def test_query_without_sql_gives_rows(spark, name):
    assert entry.queries()[name](spark, FOLDER).count() > 0


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["event_id", "user_id", "site", "rank", "obs_id", "obs_value", "age_minutes"]
    assert df.count() > 0
