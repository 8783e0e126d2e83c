"""Every registered query against its SQL, and what their plans must not contain."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries as all_queries
from barloom.catalog.queries import QUERIES
from compare import differences, duck

FOLDER = "/root/testdata/sf0.001"


def queries():
    """Those of the market-data catalogue; the others have tests of their own."""
    return {name: all_queries()[name] for name in QUERIES}


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


def test_each_query_has_its_sql():
    assert set(queries()) <= set(oracle_sql())


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, connection, name):
    rows = queries()[name](spark, FOLDER).toPandas()
    assert differences(rows, connection.execute(oracle_sql()[name]).df()) == ""
    assert len(rows) > 0


def test_entry(spark):
    assert entry(spark).columns == ["ticker", "time_stamp", "sma", "lower_bollinger",
                                    "higher_bollinger", "money_flow"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


LAZY = [n for n in queries() if not any(word in n for word in (
    "load", "refresh", "run", "store", "append", "lifecycle", "landing", "rewrite"))]


@pytest.mark.parametrize("name", LAZY)
def test_plan(spark, name):
    text = plan(queries()[name](spark, FOLDER))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython",
                     "MapInPandas", "FlatMapGroups"):
        assert unwanted not in text


def test_flagship_has_one_exchange_after_the_bars(spark):
    """Two for the bars themselves (join side and day sums), one for all windows."""
    text = plan(queries()["indicators_full"](spark, FOLDER))
    assert text.count("Exchange hashpartitioning") == 2 and text.count("+- Sort") == 1
    assert text.count("Window [") == 2


@pytest.mark.parametrize("name", ["latest_trade", "rating_snapshot"])
def test_one_row_per_key_is_cut_before_the_exchange(spark, name):
    text = plan(queries()[name](spark, FOLDER))
    exchange = text.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in text[:exchange] and "WindowGroupLimit" in text[exchange:]


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(queries()["trailing_days"](spark, FOLDER))
    pushed = text.split("PushedFilters:")[1].split("\n")[0]
    assert "GreaterThanOrEqual(l_shipdate" in pushed
    assert "l_returnflag" not in text
