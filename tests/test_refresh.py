"""Loads that go on where they stopped, and what they leave unread."""

import os
import random
import uuid
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from barloom.model import ENDPOINTS, TABLES
from barloom.operators.conform import conform
from barloom.operators.payload import PARSED, is_readable, parse_once, payload_types, rows_of
from barloom.plans import indicators as ind, loads
from barloom.session import settle
from barloom.sources import store
from barloom.sources.requests import answers, archived, fetch_pages, fetch_resumed, request_grid

BARS = "ticker string, time_stamp timestamp, open double, high double, low double, close double, volume long"


@pytest.fixture
def db(spark, tmp_path):
    name = f"db_{uuid.uuid4().hex[:8]}"
    store.create_tables(spark, name, str(tmp_path / name))
    return name


def bars(spark, rows):
    rng = random.Random(str(len(rows)))
    return spark.createDataFrame([(t, ts, 1.0, 2.0 + rng.random(), 1.0, 1 + c, int(10 * c) + 1) for t, ts, c in rows], BARS)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def derived_equals_full(spark, db):
    full = conform(ind.indicators(store.read_table(spark, db, "stock_history")), TABLES["derived_stock_history"].schema)
    exact = [F.round(c, 6).alias(c) for c in ind.OUTPUT[2:]]
    full, derived = (d.select("ticker", "time_stamp", *exact) for d in (full, store.read_table(spark, db, "derived_stock_history")))
    return full.exceptAll(derived).isEmpty() and derived.exceptAll(full).isEmpty()


def test_bars_in_any_order_end_as_one_computation(spark, db):
    """Late bars, gaps of months, new tickers, runs that derive the newest bars only: reconciled they are complete."""
    rng = random.Random(11)
    days = [(t, datetime(2020, 1, 1) + timedelta(days=d), rng.random() * 9)
            for t, every in (("A", 1), ("B", 9), ("C", 70)) for d in range(0, 200, every)]
    rng.shuffle(days)
    days.sort(key=lambda r: (r[1] > datetime(2020, 4, 1)) + (rng.random() < 0.2))
    parts = [days[:90], days[90:150], days[150:200], days[200:]]
    loads.add_bars(db, bars(spark, parts[0]))
    loads.load_indicators(spark, db, full=True)
    for part, catch_up in zip(parts[1:], (False, True, True)):
        loads.add_bars(db, bars(spark, part))
        loads.load_indicators(spark, db, full=False, catch_up=catch_up)
    loads.reconcile(spark, db)
    assert store.read_table(spark, db, "derived_stock_history").count() == len(days)
    assert derived_equals_full(spark, db)
    assert loads.differing_quarters(spark, db).filter("differs").isEmpty()


def test_a_hole_is_found_later(spark, db):
    """Three new days and a run for the newest only leave a hole that a later run of any kind may not see, but
    reconciliation does; a missing month in between is none of its business."""
    first = [("A", datetime(2024, 1, d), d / 7) for d in range(1, 10)]
    loads.add_bars(db, bars(spark, first))
    loads.load_indicators(spark, db, full=True)
    loads.add_bars(db, bars(spark, [("A", datetime(2024, 1, d), d / 7) for d in (10, 11, 12)]))
    loads.load_indicators(spark, db, full=False, catch_up=False)
    assert store.read_table(spark, db, "derived_stock_history").count() == 10
    loads.load_indicators(spark, db, full=False)
    assert store.read_table(spark, db, "derived_stock_history").count() == 10
    loads.reconcile(spark, db)
    assert derived_equals_full(spark, db)


def test_a_daily_run_reads_no_stored_bar(spark, db, monkeypatch):
    history = [(t, datetime(2023, m, d), d / 3) for t in "AB" for m in (1, 2, 3, 4, 9) for d in (1, 2, 20)]
    loads.add_bars(db, bars(spark, history))
    loads.load_indicators(spark, db, full=True)
    tail = spark.table(f"{db}.{loads.TAIL}")
    assert tail.groupBy("ticker").count().collect()[0]["count"] == 4      # a month, and the bar before it
    loads.add_bars(db, bars(spark, [("A", datetime(2023, 9, 21), 1.0), ("C", datetime(2023, 9, 21), 1.0)]))

    def unread(spark, db, name):
        assert name != "stock_history"
        return spark.table(f"{db}.{name}").select(*TABLES[name].columns)

    with monkeypatch.context() as patched:
        patched.setattr(store, "read_table", unread)
        patched.setattr(store, "rows_of_quarters", None)
        loads.load_indicators(spark, db, full=False)
    assert derived_equals_full(spark, db)
    assert spark.table(f"{db}.{loads.PENDING}").isEmpty()


def test_a_run_that_died_can_be_done_again(spark, db, monkeypatch):
    loads.add_bars(db, bars(spark, [("A", datetime(2024, 1, d), d / 7) for d in range(1, 10)]))
    loads.load_indicators(spark, db, full=True)
    loads.add_bars(db, bars(spark, [("A", datetime(2024, 1, d), d / 7) for d in (10, 11)]))
    for dying in (2, 1):         # after the tail was replaced, and before
        replace, left = store.replace_folder, [dying]

        def stop(rows, db, name):
            left[0] -= 1
            if not left[0]:
                raise ConnectionError(name)
            replace(rows, db, name)

        with monkeypatch.context() as patched:
            patched.setattr(store, "replace_folder", stop)
            with pytest.raises(ConnectionError):
                loads.load_indicators(spark, db, full=False)
    loads.load_indicators(spark, db, full=False)
    assert derived_equals_full(spark, db) and store.read_table(spark, db, "derived_stock_history").count() == 11


def test_windows_over_buckets_need_no_exchange(spark, tmp_path):
    name = f"db_{uuid.uuid4().hex[:8]}"
    store.create_tables(spark, name, str(tmp_path / name), buckets=4)
    rows = bars(spark, [(t, datetime(2023, m, d), d / 3) for t in "ABCDE" for m in (1, 2, 12) for d in (1, 2, 20)])
    store.append(rows, name, "stock_history")
    found = ind.indicators(store.read_table(spark, name, "stock_history"))
    assert "Exchange" not in plan_of(found) and found.count() == 45
    assert store.buckets_of(spark, name, "stock_history") == 4 and store.buckets_of(spark, name, "cash_flow") == 0


def test_quarters_are_pruned_by_the_join(spark, db):
    store.append(bars(spark, [(t, datetime(2023, m, 5), 1.0) for t in "AB" for m in range(1, 13)]), db, "stock_history")
    wanted = settle(spark.createDataFrame([("A", 202301), ("A", 202307), ("B", 202307)], "ticker string, p_quarter int"))
    rows = store.rows_of_quarters(spark, db, "stock_history", F.broadcast(wanted.filter("p_quarter > 202300")))
    assert sorted((r["ticker"], r["time_stamp"].month) for r in rows.collect()) == [
        *(("A", m) for m in (1, 2, 3, 7, 8, 9)), *(("B", m) for m in (7, 8, 9))]
    assert "dynamicpruning" in plan_of(rows).split("PartitionFilters: [")[1].split("]")[0]


def test_a_replacement_that_dies_changes_nothing(spark, db, monkeypatch):
    name = "cash_flow"
    schema = TABLES[name].schema
    old, new = (conform(spark.createDataFrame([(t, 2024, 1)], "ticker string, year int, quarter int"), schema, fill_missing=True)
                for t in ("OLD", "NEW"))
    store.overwrite(old, db, name)

    def die(*_):
        raise ConnectionError

    with monkeypatch.context() as patched:
        patched.setattr(store, "_switch", die)
        with pytest.raises(ConnectionError):
            store.overwrite(new, db, name)
    assert [r["ticker"] for r in store.read_table(spark, db, name).collect()] == ["OLD"]
    store.overwrite(new, db, name)
    assert [r["ticker"] for r in store.read_table(spark, db, name).collect()] == ["NEW"]
    store.overwrite(store.read_table(spark, db, name).unionByName(old), db, name)       # reads itself
    assert store.read_table(spark, db, name).count() == 2
    store.truncate_tables(spark, db, [name])
    assert store.read_table(spark, db, name).isEmpty()


ODD = ['[{"ticker":"a","year":2024.0,"quarter":1}]', '{"ticker":"a"}', "[", "[]", "{}", '[{"ticker":"a"}] x', "[null]", None, "",
       '[{"ticker":"a","year":"x"}]', '[{"ticker":"a"},]', "[1],[2]", '"[]"', ' \n[{"ticker": "b"}] ', "[3]", '{"a":1}}', '{"a":[1,{"b":2}]}',
       '{"ticker":{"a":1}}', '{"ticker":"a"', "nul", "[[]]", '[{"year":1e400}]']


@pytest.mark.parametrize("kind", ["array", "object"])
def test_one_parse_tells_what_is_readable(spark, kind):
    schema = ENDPOINTS["cash_flow"].schema
    df = spark.createDataFrame([(i, b) for i, b in enumerate(ODD)], "n int, body string")
    once = settle(parse_once(df, kind, schema))
    told = {r["n"] for r in once.filter(F.col(PARSED).isNotNull()).collect()}
    by_two = {r["n"] for r in df.filter(is_readable(kind)).collect()}
    # elements of another form than a row are noticed as well
    assert told <= by_two and {ODD[n] for n in by_two - told} <= {"[3]", "[[]]"}
    assert all((r["body"] is None) == (r["n"] in told or ODD[r["n"]] is None) for r in once.collect())
    rows = rows_of(once, kind, schema, keep=("n",)).collect()
    first = [r for r in rows if r["n"] == 0]
    assert [(r["ticker"], r["year"]) for r in first] == ([("a", 2024)] if kind == "array" else [])


def test_loads_parse_each_body_once(spark, db):
    bodies = spark.createDataFrame([("k", "A", 0, '[{"ticker":"a","year":2024,"quarter":1}]'), ("l", "B", 0, "[")],
                                   "request_key string, ticker string, flag int, body string")
    plan = plan_of(loads.parsed(bodies, "cash_flow"))
    assert plan.count("from_json") == 1
    good, failed = loads.readable(db, lambda _: bodies, "cash_flow")
    rows = loads.statements(good, "cash_flow")
    assert "from_json" not in plan_of(rows) and "json" not in plan_of(failed)
    assert [r["ticker"] for r in rows.collect()] == ["A"] and [r["ticker"] for r in failed.collect()] == ["B"]


def test_types_that_do_not_fit(spark):
    bodies = spark.createDataFrame([('{"a": 1, "b": "x", "c": 1.5, "d": null, "e": true}',), ('[{"a": 2.5, "b": 3, "f": 1}]',),
                                    ("[",), (None,)], "body string")
    schema = TABLES["cash_flow"].schema
    schema = type(schema)([f for f in spark.createDataFrame([], "a double, b string, c bigint, d double, e boolean").schema])
    found = {r["key"]: (r["sent"], r["declared"], r["values"]) for r in payload_types(bodies, schema).collect()}
    assert found == {"b": ("VARIANT", "string", 2), "c": ("DECIMAL", "bigint", 1), "f": ("BIGINT", None, 1)}


def counting(folder, fails=lambda path: False):
    def transport(paths):
        for path in paths:
            with open(os.path.join(folder, uuid.uuid4().hex), "w") as out:
                out.write(path)
            if fails(path):
                raise ConnectionError(path)
            yield f"body of {path}"

    return transport


def asked(folder):
    found = sorted(open(f.path).read() for f in os.scandir(folder))
    for f in os.scandir(folder):
        os.rename(f.path, f"{folder}-{f.name}")
    return found


def test_a_fetch_goes_on_where_it_died(spark, tmp_path):
    log, ledger = str(tmp_path / "log"), str(tmp_path / "ledger")
    os.mkdir(log)
    requests = spark.range(60).select(
        F.format_string("%02d", "id").alias("request_key"), F.lit("T").alias("ticker"), F.lit(0).alias("flag"),
        F.format_string("p%02d", "id").alias("path"))
    names = [f"p{i:02d}" for i in range(60)]
    dead = counting(log, lambda path: path >= "p50")
    assert {r["body"] for r in fetch_resumed(requests, dead, ledger, attempts=1, wave_requests=20).collect()} \
        == {None, *(f"body of {n}" for n in names[:50])}
    assert asked(log) == names
    landed = fetch_resumed(requests, counting(log), ledger)
    assert {r["body"] for r in landed.collect()} == {f"body of {n}" for n in names}
    assert asked(log) == names[50:]                               # nothing that was answered
    assert fetch_resumed(requests, counting(log), ledger).count() == 60 and asked(log) == []


def test_a_hopeless_request_is_given_up(spark, tmp_path):
    log, ledger = str(tmp_path / "log"), str(tmp_path / "ledger")
    os.mkdir(log)
    requests = spark.createDataFrame([("a", "A", 0, "pa"), ("b", "B", 0, "pb")], "request_key string, ticker string, flag int, path string")
    landed = fetch_resumed(requests, counting(log, lambda path: path == "pb"), ledger, attempts=3)
    assert {r["request_key"]: r["body"] for r in landed.collect()} == {"a": "body of pa", "b": None}
    assert asked(log) == ["pa", "pb", "pb", "pb"]


def test_errors_are_those_of_their_path():
    def ahead(paths):            # takes three paths before it answers
        held = []
        for path in paths:
            held.append(path)
            if path == "bad":
                raise ValueError
            if len(held) == 3:
                yield from held
                held = []
        yield from held

    names = ["a", "b", "c", "d", "bad", "e", "bad", "f"]
    found = list(answers(ahead, iter(names)))
    assert [(n if e is None else None) for n, (_, e) in zip(names, found)] == ["a", "b", "c", "d", None, "e", None, "f"]
    assert [b for b, _ in found] == ["a", "b", "c", "d", None, "e", None, "f"]


def test_pages_without_a_total_are_asked_for_until_one_is_not_full(spark, tmp_path):
    path = request_grid(spark.createDataFrame([("A",)], "ticker string"), "stock_intraday_transaction").head()["path"]
    sizes = {"A": [2, 2, 1], "B": [2, 2], "C": [0], "D": [1, 1]}
    archive = str(tmp_path / "archive")
    spark.createDataFrame(
        [(path.replace("/A/", f"/{t}/").replace("page=0", f"page={k}"),
          '{"size":2,%s"data":[%s]}' % ('"total":2,' if t == "D" else "", ",".join(['{"p":1}'] * n)))
         for t, pages in sizes.items() for k, n in enumerate(pages)], "path string, body string").write.parquet(archive)
    requests = request_grid(spark.createDataFrame([(t,) for t in sizes], "ticker string"), "stock_intraday_transaction")
    found = fetch_pages(requests, archived(archive)).filter("body is not null")
    assert sorted((r["ticker"], r["body"].count('"p"')) for r in found.collect()) == [
        ("A", 1), ("A", 2), ("A", 2), ("B", 2), ("B", 2), ("C", 0), ("D", 1)]


def test_numbers_are_taken_before_rows_are_written(spark, db, monkeypatch):
    name = "stock_intraday_transaction"
    assert store.take_ids(spark, db, 5) == 0 and store.take_ids(spark, db, 2) == 5
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in TABLES[name].schema if f.name not in ("id", "time_stamp")]
    store.append(spark.range(40, 43).select("id", *columns, F.lit(datetime(2024, 1, 5)).cast("timestamp").alias("time_stamp")), db, name)
    assert store.take_ids(spark, db, 1) == 7                      # the table is not read again
    spark.sql(f"TRUNCATE TABLE {db}.{store.MARKS}")
    assert store.take_ids(spark, db, 1) == 43                     # but where nothing is noted
    assert "p_date" in plan_of(store.session_rows(spark, db, name, date(2024, 1, 5)))


def test_finished_steps_are_not_repeated(spark, db):
    done, inbox = [], {"x": [("k", "A", 0, "1")], "y": [("k", "A", 0, "2")]}

    def bodies(name):
        return spark.createDataFrame(inbox[name], "request_key string, ticker string, flag int, body string")

    def step(name, fails=False):
        def work():
            done.append(name)
            if fails:
                raise ConnectionError
        return name, ["x" if name == "one" else "y"], work

    with pytest.raises(ConnectionError):
        loads.run_steps(spark, db, "r", [step("one"), step("two", fails=True)], bodies)
    assert loads.run_steps(spark, db, "r", [step("one"), step("two")], bodies) == ["two"]
    inbox["x"] = [("k", "A", 0, "changed")]
    assert loads.run_steps(spark, db, "r", [step("one"), step("two")], bodies) == ["one"]
    assert loads.run_steps(spark, db, "other", [step("one")], bodies) == ["one"]
    assert done == ["one", "two", "two", "one", "one"]
