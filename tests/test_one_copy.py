"""Loads write the rows of bodies once, and neither the bodies nor what they were parsed into."""

import os
import uuid
from datetime import date

import pytest

from barloom.catalog import queries
from barloom.plans import loads
from barloom.sources import store


@pytest.fixture
def db(spark, tmp_path):
    name = f"db_{uuid.uuid4().hex[:8]}"
    store.create_tables(spark, name, str(tmp_path / name))
    return name


def kept_aside(spark):
    return set(os.listdir(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")))


def bodies_of(spark, *rows):
    return spark.createDataFrame([(f"k{i}", *r) for i, r in enumerate(rows)],
                                 "request_key string, ticker string, flag int, body string")


def test_unreadable_bodies_stand_among_the_rows(spark, db):
    before = kept_aside(spark)
    sent = bodies_of(spark, ("a", 0, '[{"ticker":"a","year":2024,"quarter":1},{"year":2023}]'), ("b", 0, "[]"),
                     ("c", 0, "["), ("d", 0, None))
    loads.readable(db, lambda _: sent, "cash_flow")
    good, failed = loads.readable(db, lambda _: sent, "cash_flow")
    new = {n.rsplit("-", 1)[0] for n in kept_aside(spark) - before}
    assert new == {"rows-cash_flow"} and "body" not in good.columns
    assert sorted((r["ticker"] or "", r["year"]) for r in good.collect()) == [("", 2023), ("a", 2024)]
    assert sorted(r["ticker"] for r in failed.collect()) == ["C", "D"]
    assert sorted((r["ticker"], r["content"]) for r in store.rejects(spark, db).collect()) == [("C", "["), ("D", None)]


def test_ratings_are_appended_without_another_copy(spark, db):
    before = kept_aside(spark)
    names = ["general_rating", *(n for n in loads.RATINGS if n != "general_rating")]
    sent = {n: bodies_of(spark, ("a", 0, '{"ticker":"a"}'), ("A", 1, '{"ticker":"A"}'), ("b", 0, "oops")) for n in names}
    for _ in range(2):
        loads.load_ratings(db, sent.get, date(2024, 2, 15))
    assert {n.rsplit("-", 1)[0] for n in kept_aside(spark) - before} == {f"rows-{n}" for n in names}
    assert [(r["ticker"], r["quarter"]) for r in store.read_table(spark, db, "general_rating").collect()] == [("A", 1)]


def test_a_sample_lands_its_tickers_only(spark):
    few = spark.createDataFrame([("Customer#000000001",)], "ticker string")
    found = queries._inbox(spark, "/root/testdata/sf0.001", few)("cash_flow")
    assert {r["ticker"] for r in found.collect()} <= {"Customer#000000001"}
