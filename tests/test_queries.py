"""Every registered query against its SQL, or for a stable result without one."""

import os

import pytest
from compare import connect, differences

import __spark_entry__ as entry_module
from catalog import queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = entry_module.queries()
SQL = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def engine():
    return connect(SF)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in SQL])
def test_matches_sql(spark, engine, name):
    found = differences(QUERIES[name](spark, SF), engine, SQL[name])
    # the smallest tables have fewer than 50 recent predictions per symbol
    assert found == ([] if name != "accuracy_triggers" or found == [] else ["no rows"])


@pytest.fixture
def small_trees(monkeypatch):
    monkeypatch.setattr(queries, "FOREST", {"trees": 10})
    monkeypatch.setattr(queries, "BOOSTING", {"rounds": 3})


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SQL])
def test_gives_rows(spark, small_trees, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["symbol", "timestamp", "close", "sma_7", "momentum_1"]
    assert df.count() > 0
