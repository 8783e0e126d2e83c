"""What loads and fetches do once for a long list, and not once for every part or repeat of it."""

import json
import uuid
from datetime import date

import pytest
from pyspark.sql import functions as F

from barloom.catalog import queries
from barloom.plans import loads
from barloom.sources import requests as R, store


@pytest.fixture
def db(spark, tmp_path):
    name = f"db_{uuid.uuid4().hex[:8]}"
    store.create_tables(spark, name, str(tmp_path / name))
    return name


def asked_for(spark, n):
    return spark.range(n).select(
        F.format_string("%02d", "id").alias("request_key"), F.lit("T").alias("ticker"), F.lit(0).alias("flag"),
        F.format_string("p%02d", "id").alias("path"))


def test_waves_are_fewer_than_a_long_list_has_parts(spark, tmp_path, monkeypatch):
    assert [R._waves(n, 10) for n in (0, 1, 10, 11, 90, 91, 1000)] == [0, 1, 1, 2, 3, 4, 10]
    waves, fetched = [], R._fetched
    monkeypatch.setattr(R, "_fetched", lambda s, listed, *rest: (waves.append(listed), fetched(s, listed, *rest))[1])
    found = R.fetch_resumed(asked_for(spark, 90), lambda paths: (f"b{p}" for p in paths), str(tmp_path / "ledger"),
                            wave_requests=10, partitions=2)
    assert len(waves) == 3 and {r["body"] for r in found.collect()} == {f"bp{i:02d}" for i in range(90)}


def test_bodies_without_a_failure_are_read_once(spark, tmp_path):
    found = R.fetch_resumed(asked_for(spark, 4), lambda paths: (f"b{p}" for p in paths), str(tmp_path / "ledger"))
    assert "Join" not in found._jdf.queryExecution().toString() and found.count() == 4


def test_a_body_is_recorded_once_for_companies_of_one_name(spark, tmp_path):
    folder = str(tmp_path)
    spark.range(5).select(
        F.col("id").alias("c_custkey"), F.when(F.col("id") < 4, "same").alias("c_name"), F.lit(0).alias("c_nationkey"),
        F.lit(1.5).alias("c_acctbal"), F.lit("M").alias("c_mktsegment")).write.parquet(f"{folder}/customer.parquet")
    spark.sql("select 0 as n_nationkey, 'N' as n_name, 0 as n_regionkey").write.parquet(f"{folder}/nation.parquet")
    found = queries._recorded(spark, folder, ["listing_companies", "valuation_rating"])
    counts = {r["path"]: r["count"] for r in found.groupBy("path").count().collect()}
    asked = R.request_grid(spark.createDataFrame([("same",)], "ticker string"), "listing_companies").head()["path"]
    assert counts[asked] == 4 and max(counts.values()) == 4


def test_trades_are_written_aside_once_and_by_ranges(spark, db, monkeypatch):
    rows = [{"p": 1.0 * i, "v": i, "t": f"09:00:{i:02d}"} for i in range(40)]
    body = json.dumps({"page": 0, "ticker": "aa", "data": rows})
    unnamed = json.dumps({"page": 0, "data": rows[:1]})
    bodies = spark.createDataFrame([("k", "aa", 0, body), ("n", "bb", 0, unnamed)],
                                   "request_key string, ticker string, flag int, body string")
    aside, settle, name = [], store.settle, "stock_intraday_transaction"
    monkeypatch.setattr(store, "settle", lambda df, *rest, **kept: (aside.append(df), settle(df, *rest, **kept))[1])
    monkeypatch.setattr(loads, "RANGE_ROWS", 10)
    loads.load_trades(spark, db, lambda _: bodies, date(2024, 1, 5))
    assert len(aside) == 1                              # what is new; bodies' rows are written by readable alone
    stored = store.read_table(spark, db, name)
    assert [r["volume"] for r in stored.orderBy("id").collect()] == list(range(40))
    assert [r["id"] for r in stored.orderBy("id").collect()] == list(range(40))
    assert [r["reason"] for r in store.rejects(spark, db).collect()] == ["null key"]
    assert len(spark.table(f"{db}.{name}").inputFiles()) > 1     # one task would have written a day
