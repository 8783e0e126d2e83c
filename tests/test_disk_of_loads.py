"""What loads write and shuffle: the rows of statements once, real numbers as they are, no table for a few rows of it."""

import os
import threading
import uuid
from datetime import date

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from barloom.catalog import fixtures as fx, queries
from barloom.model import ENDPOINTS, RATINGS, STATEMENTS
from barloom.operators.payload import PARSED, parse_once, unreadable
from barloom.plans import loads
from barloom.sources import store

BODIES = "request_key string, ticker string, flag int, body string"


@pytest.fixture
def db(spark, tmp_path):
    name = f"db_{uuid.uuid4().hex[:8]}"
    store.create_tables(spark, name, str(tmp_path / name))
    return name


def kept_aside(spark):
    return set(os.listdir(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")))


def names_of(folders):
    return sorted(n.rsplit("-", 1)[0] for n in folders)


def bodies_of(spark, *rows):
    return spark.createDataFrame([(f"k{i}", *r) for i, r in enumerate(rows)], BODIES)


def cash(ticker, *rows):
    return "[" + ",".join(f'{{"ticker":"{ticker}","year":{y},"quarter":{q},"freeCashFlow":{v}}}' for y, q, v in rows) + "]"


def stored_rows(spark, db):
    return sorted((r["ticker"], r["year"], r["quarter"], r["free_cash_flow"])
                  for r in store.read_table(spark, db, "cash_flow").collect())


def test_rows_of_statements_are_written_once(spark, db):
    first = {n: bodies_of(spark, ("a", 0, "[]")) for n in STATEMENTS}
    first["cash_flow"] = bodies_of(spark, ("a", 0, cash("a", (2023, 1, 1.5), (2023, 2, 2.5))), ("b", 0, cash("b", (2023, 1, 3.5))),
                                   ("b", 1, '[{"ticker":"b","year":2023}]'), ("d", 0, cash("d", (2023, 1, 4.5))))
    before = kept_aside(spark)
    loads.load_statements(db, first.get)
    assert names_of(kept_aside(spark) - before) == []
    assert stored_rows(spark, db) == [("A", 2023, 1, 1.5), ("A", 2023, 2, 2.5), ("B", 2023, 1, 3.5), ("D", 2023, 1, 4.5)]
    assert store.rejects(spark, db).isEmpty()
    # a fails but for a body that has one of its quarters; c fails and has none; d is gone
    second = first | {"cash_flow": bodies_of(spark, ("a", 0, "<html>"), ("a", 1, cash("a", (2023, 1, 9.5))), ("c", 0, None),
                                             ("b", 0, cash("b", (2023, 1, 5.5))))}
    for _ in range(2):
        before = kept_aside(spark)
        loads.load_statements(db, second.get)
        assert not any(n.startswith("rows-") for n in kept_aside(spark) - before)
        assert stored_rows(spark, db) == [("A", 2023, 1, 9.5), ("A", 2023, 2, 2.5), ("B", 2023, 1, 5.5)]
    assert sorted(r["ticker"] for r in store.rejects(spark, db).collect()) == ["A", "C"]


def test_a_load_of_statements_that_dies_changes_nothing(spark, db, monkeypatch):
    sent = {n: bodies_of(spark, ("a", 0, cash("a", (2023, 1, 1.5)))) for n in STATEMENTS}
    loads.load_statements(db, sent.get)
    failing = {n: bodies_of(spark, ("a", 0, "oops")) for n in STATEMENTS}

    def die(*_):
        raise ConnectionError

    with monkeypatch.context() as patched:
        patched.setattr(store, "_switch", die)
        with pytest.raises(ConnectionError):
            loads.load_statements(db, failing.get)
    assert stored_rows(spark, db) == [("A", 2023, 1, 1.5)]


def test_unreadable_is_what_parsing_leaves(spark):
    odd = ["[]", "[", "{}", None, "", '[{"year":1}] x', "[null]", "[3]", "[1],[2]", ' \n[{"ticker": "b"}] ', '[{"year":"x"}]',
           '"[]"', "nul", "[[]]", '{"ticker":"a"}', '{"ticker":{"a":1}}', '{"ticker":"a"', '{"a":1}}', '[{"ticker":"a"},]']
    sent = bodies_of(spark, *((str(i), 0, body) for i, body in enumerate(odd)))
    for name in ("cash_flow", "valuation_rating", "stock_history"):
        endpoint = ENDPOINTS[name]
        left = parse_once(sent, endpoint.kind, endpoint.schema).filter(F.col(PARSED).isNull())
        found = unreadable(sent, endpoint.kind, endpoint.schema)
        assert {r["ticker"] for r in found.collect()} == {r["ticker"] for r in left.collect()} != set()
        assert found._jdf.queryExecution().executedPlan().toString().count("from_json") == 1


def test_kept_rows_shuffle_no_row_of_another_ticker(spark):
    rows = spark.range(100).select(F.format_string("T%02d", "id").alias("ticker"), F.lit(1).alias("year"))
    failed = spark.createDataFrame([("T07",), ("T08",), ("gone",)], "ticker string")
    kept = loads.kept_rows(rows.filter("ticker <> 'T08'"), failed, rows, ["ticker", "year"])
    assert [r["ticker"] for r in kept.collect()] == ["T08"]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_real_numbers_are_stored_as_they_are(spark, db):
    sent = {n: bodies_of(spark, ("a", 0, cash("a", *((y, 1, 1.5) for y in range(1900, 2000))))) for n in STATEMENTS}
    loads.load_statements(db, sent.get)
    rated = {n: bodies_of(spark, ("a", 0, '{"ticker":"a"}')) for n in RATINGS}
    loads.load_ratings(db, rated.get, date(2024, 2, 15))
    for name in ("cash_flow", "valuation_rating"):
        group = pq.ParquetFile(spark.table(f"{db}.{name}").inputFiles()[0].removeprefix("file://")).metadata.row_group(0)
        columns = [group.column(i) for i in range(group.num_columns)]
        real = [c for c in columns if c.physical_type == "DOUBLE"]
        assert real and {c.compression for c in columns} == {"ZSTD"}
        assert not any("DICTIONARY" in e for c in real for e in c.encodings)


def test_ratings_are_not_shuffled_to_be_written(spark, db, monkeypatch):
    dealt, append = [], store.append
    monkeypatch.setattr(store, "append", lambda *rest, **kept: (dealt.append(kept.get("dealt")), append(*rest, **kept))[1])
    sent = {n: bodies_of(spark, *((f"t{i}", 0, f'{{"ticker":"t{i}"}}') for i in range(20))) for n in RATINGS}
    for _ in range(2):
        loads.load_ratings(db, sent.get, date(2024, 2, 15))
    assert dealt == [True] * 12
    assert all(store.read_table(spark, db, n).count() == 20 for n in RATINGS)


def test_statements_are_made_of_rows_that_are_grouped_once(spark, tmp_path):
    folder, before = str(tmp_path), kept_aside(spark)
    spark.range(5).select(F.col("id").alias("c_custkey"), F.when(F.col("id") < 4, F.concat(F.lit("c"), F.col("id") % 3)).alias(
        "c_name")).write.parquet(f"{folder}/customer.parquet")
    spark.range(60).select((F.col("id") % 6).alias("o_custkey"), F.date_add(F.lit("2023-01-01").cast("date"), (
        F.col("id") * 20).cast("int")).alias("o_orderdate"), (F.col("id") / 8).alias("o_totalprice")).write.parquet(
        f"{folder}/orders.parquet")
    inbox = queries._inbox(spark, folder)
    for name in STATEMENTS:
        size = [F.col("request_key"), F.json_array_length("body")]
        sent, made = inbox(name).select(*size), fx.bodies(spark, folder, name).select(*size)
        assert sent.exceptAll(made).isEmpty() and made.exceptAll(sent).isEmpty() and not sent.isEmpty()
    assert names_of(kept_aside(spark) - before) == sorted(["lists", *(f"landed-{n}" for n in STATEMENTS)])


def test_inputs_of_a_step_are_read_side_by_side(spark):
    both = threading.Barrier(2, timeout=30)

    def inbox(name):
        both.wait()
        return bodies_of(spark, (name, 0, "1"))

    parts = loads.inputs_digest(inbox, ["x", "y"]).split(",")
    assert [p.split(":")[:2] for p in parts] == [["x", "1"], ["y", "1"]]
