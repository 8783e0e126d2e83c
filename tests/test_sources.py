import json
import os
import uuid
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from barloom.model import TABLES
from barloom.operators.conform import conform
from barloom.plans import loads
from barloom.sources import jdbc, store
from barloom.sources.requests import (
    bar_requests, fetch, fetch_recorded, request_grid, trade_requests)


@pytest.fixture
def db(spark, tmp_path):
    name = f"db_{uuid.uuid4().hex[:8]}"
    store.create_tables(spark, name, str(tmp_path / name))
    return name


def bars(spark, *rows):
    return spark.createDataFrame([(t, ts, 1.0, 1.0, 1.0, c, 10) for t, ts, c in rows],
                                 "ticker string, time_stamp timestamp, open double, high double,"
                                 " low double, close double, volume long")


def stored(spark, db, name="stock_history"):
    return sorted((r["ticker"], r["time_stamp"], r["close"])
                  for r in store.read_table(spark, db, name).collect())


OLD, NEW = datetime(2020, 5, 1), datetime(2021, 1, 10)


def test_tables_have_the_declared_columns(spark, db):
    for name, table in TABLES.items():
        assert store.table_schema(spark, db, name).names == table.columns


def test_append_overwrite_and_rewrite(spark, db):
    store.append(bars(spark, ("A", OLD, 1.0), ("B", NEW, 2.0)), db, "stock_history")
    store.append(bars(spark, ("A", NEW, 3.0)), db, "stock_history")
    assert len(stored(spark, db)) == 3
    store.rewrite(store.read_table(spark, db, "stock_history").filter("ticker = 'A'"), db,
                  "stock_history")
    assert stored(spark, db) == [("A", OLD, 1.0), ("A", NEW, 3.0)]
    store.overwrite(bars(spark, ("C", NEW, 4.0)), db, "stock_history")
    assert stored(spark, db) == [("C", NEW, 4.0)]


def test_append_new_twice(spark, db):
    first = bars(spark, ("A", OLD, 1.0), ("A", OLD, 0.5), ("B", NEW, 2.0))
    store.append_new(first, db, "stock_history")
    store.append_new(first.union(bars(spark, ("B", OLD, 9.0))), db, "stock_history")
    assert stored(spark, db) == [("A", OLD, 0.5), ("B", OLD, 9.0), ("B", NEW, 2.0)]


def test_trailing_rows_read_only_recent_years(spark, db):
    store.append(bars(spark, ("A", OLD, 1.0), ("A", datetime(2020, 12, 20), 2.0), ("A", NEW, 3.0)),
                 db, "stock_history")
    recent = store.trailing_rows(spark, db, "stock_history", F.lit(NEW).cast("timestamp"))
    assert sorted(r["close"] for r in recent.collect()) == [2.0, 3.0]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p_quarter" in plan and "202010" in plan


def test_life_of_the_tables(spark, db):
    store.append(bars(spark, ("A", OLD, 1.0)), db, "stock_history")
    store.create_tables(spark, db)
    assert len(stored(spark, db)) == 1
    store.truncate_tables(spark, db)
    assert stored(spark, db) == []
    store.drop_tables(spark, db)
    assert spark.catalog.listTables(db) == []


def test_jdbc_options():
    """No database is started here; only what is asked of Spark is checked."""
    read = jdbc.read_options("jdbc:x", "t", ("id", "0", "100", 8), user="u")
    assert read == {"url": "jdbc:x", "dbtable": "t", "user": "u", "partitionColumn": "id",
                    "lowerBound": "0", "upperBound": "100", "numPartitions": "8"}
    assert "truncate" not in jdbc.write_options("jdbc:x", "t")
    assert jdbc.write_options("jdbc:x", "t", overwrite=True)["truncate"] == "true"


def test_request_grid(spark):
    tickers = spark.createDataFrame([("A",), ("B",)], "ticker string")
    rows = request_grid(tickers, "cash_flow").orderBy("request_key").collect()
    assert [r["path"] for r in rows] == [
        f"finance/{t}/cashflow?yearly={i}&isAll=True" for t in "AB" for i in range(2)]
    bars_of = bar_requests(tickers, "1970-01-02", "1970-01-03").orderBy("ticker").collect()
    assert bars_of[0]["path"].endswith("ticker=A&type=stock&resolution=D&from=86400&to=172800")
    friday, saturday = (trade_requests(tickers, F.lit(date(2024, 1, d))).head()["path"] for d in (5, 6))
    assert saturday == friday + "&headIndex=-1"


def test_every_request_is_fetched_once(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()

    def counting(paths):
        for path in paths:
            with open(os.path.join(str(log), uuid.uuid4().hex), "w") as out:
                out.write(path)
            yield None if path == "p7" else f"body of {path}"

    requests = spark.range(1000).select(
        F.col("id").cast("string").alias("request_key"), F.lit("T").alias("ticker"),
        F.lit(0).alias("flag"), F.concat(F.lit("p"), F.col("id")).alias("path"))
    landed = fetch(requests, counting, partitions=3)
    landed.orderBy("ticker").collect()
    assert len(list(log.iterdir())) == 1000
    found = {r["request_key"]: r["body"] for r in landed.collect()}
    assert found == {str(i): None if i == 7 else f"body of p{i}" for i in range(1000)}


def test_bodies_kept_as_files(spark, tmp_path):
    (tmp_path / "a.json").write_text("[1]\nä")
    requests = spark.createDataFrame(
        [("a", "A", 0, str(tmp_path / "a.json")), ("b", "B", 0, str(tmp_path / "b.json"))],
        "request_key string, ticker string, flag int, path string")
    assert {r["ticker"]: r["body"] for r in fetch(requests).collect()} == {"A": "[1]\nä", "B": None}


def test_replay_over_row_groups(spark, tmp_path):
    archive = str(tmp_path / "archive")
    rows = spark.range(5000).select(
        F.col("id").cast("string").alias("request_key"), F.lit("T").alias("ticker"),
        F.lit(1).alias("flag"), F.repeat(F.col("id").cast("string"), 50).alias("body"))
    (rows.repartition(3).write.option("parquet.block.size", 4096)
     .option("parquet.block.size.row.check.min", 10).parquet(archive))
    landed = fetch_recorded(spark, archive, partitions=5)
    assert landed.exceptAll(rows).isEmpty() and rows.exceptAll(landed).isEmpty()


# Loads ------------------------------------------------------------------------------------------

def inbox_of(spark, made):
    def inbox(dataset):
        rows = [(f"{dataset}/{i}", t, f, b) for i, (t, f, b) in enumerate(made.get(dataset, []))]
        return spark.createDataFrame(rows, "request_key string, ticker string, flag int, body string")
    return inbox


def small_world():
    tickers = ["aa", "bb", "cc", "dd"]
    made = {name: [] for name in TABLES}
    for t in tickers:
        made["listing_companies"].append((t, 0, json.dumps(
            {"ticker": t, "shortName": f"Company {t}", "industryID": 7, "issueShare": 5})))
        for flag in (0, 1):
            made["balance_sheet"].append((t, flag, json.dumps(
                [{"ticker": t, "year": 2023, "quarter": 5 if flag else 4, "asset": 100.0},
                 {"ticker": t, "year": None, "quarter": 1}])))
            made["general_rating"].append((t, flag, json.dumps(
                {"ticker": t, "stockRating": 3, "priceChange3m": 0.5})))
        made["stock_history"].append((t, 0, json.dumps({"ticker": t, "data": [
            {"open": 1, "high": 2, "low": 1, "close": 1 + d, "volume": 10 * d,
             "tradingDate": f"2024-01-0{d}T00:00:00.000Z"} for d in range(1, 6)]})))
        trade = {"p": 11.0, "v": 100, "a": "BU", "hl": True, "t": "09:15:03"}
        made["stock_intraday_transaction"].append((t, 0, json.dumps(
            {"page": 0, "ticker": t, "data": [trade, trade, {"p": 12, "v": 1}]})))
    made["cash_flow"] = [("aa", 0, "[]"), ("bb", 0, "oops"), ("cc", 0, '{"not":"array"}')]
    return made


def test_sample_run(spark, db):
    made = small_world()
    inbox = inbox_of(spark, made)
    tickers = spark.createDataFrame([("dd",), ("aa",), ("cc",), ("bb",)], "ticker string")
    loads.sample_run(spark, db, inbox, tickers, date(2024, 1, 5))
    count = {name: store.read_table(spark, db, name).count() for name in TABLES}
    assert {n: c for n, c in count.items() if c} == {
        "listing_companies": 3, "companies_info": 3, "balance_sheet": 6, "general_rating": 3,
        "stock_history": 15, "derived_stock_history": 15, "stock_intraday_transaction": 9}
    rating = store.read_table(spark, db, "general_rating").orderBy("ticker").head()
    assert (rating["ticker"], rating["year"], rating["quarter"], rating["price_change3m"]) == (
        "AA", 2024, 1, 0.5)
    bad = store.rejects(spark, db)
    assert sorted((r["dataset"], r["ticker"]) for r in bad.collect()) == [
        ("cash_flow", "BB"), ("cash_flow", "CC")]


def test_trades_of_a_growing_session(spark, db):
    """Polled three times a day: only what is new is added, equal trades keep their number."""
    made = small_world()
    day = date(2024, 1, 5)
    loads.load_trades(spark, db, inbox_of(spark, made), day)
    loads.load_trades(spark, db, inbox_of(spark, made), day)
    more = json.loads(made["stock_intraday_transaction"][0][2])
    more["data"] += [more["data"][0], {"p": 13, "v": 2, "t": "10:00:00"}]
    made["stock_intraday_transaction"][0] = ("aa", 0, json.dumps(more))
    loads.load_trades(spark, db, inbox_of(spark, made), day)
    rows = store.read_table(spark, db, "stock_intraday_transaction").collect()
    assert sorted(r["id"] for r in rows) == list(range(14))
    mine = [r for r in rows if r["ticker"] == "AA"]
    assert sum(r["price"] == 11.0 for r in mine) == 3 and sum(r["price"] == 13.0 for r in mine) == 1
    assert {r["time_stamp"] for r in mine if r["price"] == 12.0} == {datetime(2024, 1, 5)}


def test_new_companies_only(spark, db):
    made = small_world()
    loads.load_companies(spark, db, inbox_of(spark, made))
    made["listing_companies"] = made["listing_companies"][2:] + [
        ("ee", 0, json.dumps({"ticker": "ee", "issueShare": 9}))]
    loads.load_companies(spark, db, inbox_of(spark, made))
    listing = store.read_table(spark, db, "listing_companies").collect()
    info = store.read_table(spark, db, "companies_info").collect()
    assert sorted(r["ticker"] for r in listing) == ["AA", "BB", "CC", "DD", "EE"]
    assert sorted(r["ticker"] for r in info) == ["CC", "DD", "EE"]


def test_daily_refresh_continues_the_indicators(spark, db):
    history = bars(spark, *((t, datetime(2024, 1, d), float(d)) for t in "AB" for d in range(1, 9)))
    store.append(history, db, "stock_history")
    loads.load_indicators(spark, db, full=True)
    loads.add_bars(db, bars(spark, ("A", datetime(2024, 1, 9), 5.0)))
    loads.load_indicators(spark, db, full=False)
    derived = store.read_table(spark, db, "derived_stock_history")
    assert derived.count() == 17
    from barloom.plans.indicators import indicators
    again = indicators(store.read_table(spark, db, "stock_history"))
    assert conform(again, TABLES["derived_stock_history"].schema).exceptAll(derived).isEmpty()


def test_batches_end_by_size_and_bodies_stay_whole(spark, monkeypatch, tmp_path):
    from barloom.sources import requests as source

    monkeypatch.setattr(source, "BATCH_CHARS", 10)
    listed = str(tmp_path / "requests")
    spark.createDataFrame([(f"k{i}", "t", 0, str(i)) for i in range(9)],
                          "request_key string, ticker string, flag int, path string"
                          ).coalesce(1).write.parquet(listed)
    sizes = [25, 0, 3, 3, 3, 3, 40, 1, None]

    def transport(paths):
        for path in paths:
            size = sizes[int(path)]
            yield None if size is None else "x" * size

    reader = source._BodyReader(listed, transport)
    batches = [b for p in reader.partitions() for b in reader.read(p)]
    assert [b.num_rows for b in batches] == [1, 5, 1, 2]
    texts = [x for b in batches for x in b.column("body").to_pylist()]
    assert [None if x is None else len(x) for x in texts] == sizes
    assert [x for b in batches for x in b.column("request_key").to_pylist()] == [f"k{i}" for i in range(9)]


def test_rows_since_prune_quarters(spark):
    from datetime import datetime

    from barloom.catalog.queries import _new_db
    from barloom.sources import store

    db = _new_db(spark)
    plan = store.rows_since(spark, db, "stock_history", datetime(2001, 5, 1))._jdf.queryExecution().toString()
    partition_filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "p_quarter" in partition_filters and "200104" in partition_filters
