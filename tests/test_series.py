"""Windows and order against brute force, with one key holding most of the rows."""

import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from barloom.operators.ordering import (
    first_per_key, lag_by_key, latest_per_key, ordered_id, ticker_sample)
from barloom.operators.rolling import rolling, rolling_ratio
from barloom.plans.indicators import indicators, latest_indicators, recent_bars

SPAN = 50


def series(n=900, seed=1, unique=False, start=-400):
    """Rows of which key "hot" has two thirds, with gaps, negative seconds and null values."""
    rng = random.Random(seed)
    rows, seen = [], set()
    while len(rows) < n:
        key = rng.choice(["hot", "hot", "hot", "hot", "a", None])
        sec = start + rng.randrange(0, 3000) + (5000 if rng.random() < 0.1 else 0)
        if unique and (key, sec) in seen:
            continue
        seen.add((key, sec))
        rows.append((len(rows), key, sec, None if rng.random() < 0.1 else float(rng.randrange(100)),
                     rng.randrange(10)))
    return rows


SCHEMA = "id long, key string, sec long, x double, y long"


def brute(rows, span):
    found = {}
    for i, key, sec, _, _ in rows:
        frame = [r for r in rows if r[1] == key and sec - span <= r[2] <= sec]
        xs = [r[3] for r in frame if r[3] is not None]
        found[i] = (sum(xs) if xs else None, sum(xs) / len(xs) if xs else None, len(xs),
                    sum(r[4] for r in frame))
    return found


@pytest.mark.parametrize("unique,step,part", [
    (False, 0, 60), (False, 0, 1000), (True, 1, 60), (True, 1, 5000), (False, SPAN, 60)])
def test_rolling(spark, unique, step, part):
    rows = series(unique=unique)
    outputs = {"s": ("sum", "x"), "m": ("avg", "x"), "n": ("count", "x"), "t": ("sum", "y")}
    got = rolling(spark.createDataFrame(rows, SCHEMA), ["key"], "sec", outputs, span=SPAN,
                  step_seconds=step, part_seconds=part)
    assert got.columns == ["id", "key", "sec", "x", "y", "s", "m", "n", "t"]
    result = {r["id"]: (r["s"], pytest.approx(r["m"]) if r["m"] is not None else None, r["n"],
                        r["t"]) for r in got.collect()}
    assert len(result) == len(rows)
    for i, expected in brute(rows, SPAN).items():
        assert expected == result[i]


def test_rows_exactly_one_span_apart_share_a_frame(spark):
    df = spark.createDataFrame([(0, "k", 0, 1.0, 0), (1, "k", SPAN, 2.0, 0),
                                (2, "k", 2 * SPAN + 1, 4.0, 0)], SCHEMA)
    for step in (0, 1, SPAN):
        got = rolling(df, ["key"], "sec", {"s": ("sum", "x")}, span=SPAN, step_seconds=step)
        assert [r["s"] for r in got.orderBy("id").collect()] == [1.0, 3.0, 4.0]


def test_rolling_ratio_by_zero_is_null(spark):
    df = spark.createDataFrame([(0, "k", 0, 1.0, 0), (1, "k", 10, 2.0, 4)], SCHEMA)
    got = rolling_ratio(df, ["key"], "sec", "x", "y", span=SPAN).orderBy("id").collect()
    assert [r["ratio"] for r in got] == [None, 0.75]


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_lag_by_key(spark, partitions):
    rows = series(600)
    got = lag_by_key(spark.createDataFrame(rows, SCHEMA), ["key"], ["sec", "id"],
                     {"before": "x", "before_id": "id"}, partitions)
    assert got.columns == ["id", "key", "sec", "x", "y", "before", "before_id"]
    result = {r["id"]: (r["before"], r["before_id"]) for r in got.collect()}
    expected = {}
    for key in {r[1] for r in rows}:
        last = (None, None)
        for r in sorted((r for r in rows if r[1] == key), key=lambda r: (r[2], r[0])):
            expected[r[0]] = last
            last = (r[3], r[0])
    assert result == expected


@pytest.mark.parametrize("partitions", [1, 7])
def test_ordered_id_is_dense_and_ordered(spark, partitions):
    rows = series(500)
    got = ordered_id(spark.createDataFrame(rows, SCHEMA), ["key", "sec", "id"], "n", 100, partitions)
    numbered = [r["id"] for r in sorted(got.collect(), key=lambda r: r["n"])]
    assert sorted(r["n"] for r in got.collect()) == list(range(100, 600))
    assert numbered == [r[0] for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or "", r[2], r[0]))]
    assert dict(got.dtypes)["n"] == "bigint"


def test_one_row_per_key(spark):
    df = spark.createDataFrame(series(), SCHEMA)
    first = {r["key"]: r["id"] for r in first_per_key(df, ["key"], ["id"]).collect()}
    latest = {r["key"]: r["id"] for r in latest_per_key(df, ["key"], "sec", ["id"]).collect()}
    rows = series()
    for key in {r[1] for r in rows}:
        mine = [r for r in rows if r[1] == key]
        assert first[key] == min(r[0] for r in mine)
        assert latest[key] == max(mine, key=lambda r: (r[2], r[0]))[0]
    assert [r["id"] for r in ticker_sample(df, 3, "id").collect()] == [0, 1, 2]


# Indicators -------------------------------------------------------------------------------------

def bar_frame(spark, rows):
    """(ticker, day, price, volume) with high = low = close."""
    start = datetime(2024, 1, 1)
    return spark.createDataFrame(
        [(t, start + timedelta(days=d), p, p, p, p, v) for t, d, p, v in rows],
        "ticker string, time_stamp timestamp, open double, high double, low double, close double,"
        " volume long")


def test_hand_computed(spark):
    """First bar, a rise, a tie, a fall, and a rise after a gap longer than the frame."""
    bars = bar_frame(spark, [("A", 0, 10.0, 100), ("A", 1, 12.0, 200), ("A", 2, 12.0, 300),
                             ("A", 3, 9.0, 400), ("A", 60, 18.0, 500)])
    rows = indicators(bars).orderBy("time_stamp").collect()
    assert [r["sma"] for r in rows] == [100.0, 150.0, 200.0, 250.0, 500.0]
    distances = [90.0**2, 138.0**2, 188.0**2, 241.0**2]
    deviations = [(sum(distances[:i + 1]) / 30) ** 0.5 for i in range(4)] + [(482.0**2 / 30) ** 0.5]
    for row, deviation, volume in zip(rows, deviations, [100, 200, 300, 400, 500]):
        assert row["higher_bollinger"] == pytest.approx(volume - deviation)
        assert row["lower_bollinger"] == pytest.approx(volume + deviation)
    # nothing fell before the fourth bar; then 12 rose and 9 fell; after the gap only 18 rose
    assert [r["money_flow"] for r in rows[:3]] == [None] * 3
    assert rows[3]["money_flow"] == pytest.approx(100 - 100 / (1 - 12 / 9))
    assert rows[4]["money_flow"] is None


def test_equal_rise_and_fall_give_null(spark):
    bars = bar_frame(spark, [("A", 0, 10.0, 1), ("A", 1, 11.0, 1), ("A", 2, 12.0, 1), ("A", 3, 11.0, 1),
                             ("A", 4, 12.0, 1), ("A", 5, 10.0, 1), ("A", 6, 14.0, 1)])
    row = indicators(bars).filter("time_stamp = '2024-01-02'").head()
    assert row["money_flow"] is None
    bars = bar_frame(spark, [("A", 0, 5.0, 1), ("A", 1, 10.0, 1), ("A", 2, 8.0, 1),
                             ("A", 3, 2.0, 1)])  # rose 10, fell 8 + 2
    assert indicators(bars).orderBy("time_stamp").tail(1)[0]["money_flow"] is None


def random_bars(spark, seed=3):
    rng = random.Random(seed)
    rows = []
    for ticker, chance in [("HOT", 0.9), ("RARE", 0.02), ("MID", 0.3)]:
        rows += [(ticker, d, float(rng.randrange(1, 50)), rng.randrange(1, 1000))
                 for d in range(0, 1500) if rng.random() < chance]
    rows += [("ONE", 700, 5.0, 10), ("OLD", 0, 5.0, 10), ("OLD", 1, 6.0, 10)]
    return bar_frame(spark, rows)


def as_pandas(df):
    return df.toPandas().sort_values(["ticker", "time_stamp"]).reset_index(drop=True)


@pytest.mark.parametrize("months", [2, 5, 100])
def test_parts_do_not_change_the_result(spark, months):
    bars = random_bars(spark)
    parted = indicators(bars, step_seconds=1, part_seconds=months * 2_629_800)
    pd.testing.assert_frame_equal(as_pandas(parted), as_pandas(indicators(bars)))


def test_bounded_look_back_equals_the_full_computation(spark):
    bars = random_bars(spark)
    full = as_pandas(indicators(bars)).groupby("ticker").tail(1).reset_index(drop=True)
    pd.testing.assert_frame_equal(as_pandas(latest_indicators(bars)), full)
    slim, shuffled = recent_bars(bars), recent_bars(bars, broadcast_rows=0)
    assert slim.exceptAll(shuffled).isEmpty() and slim.count() == shuffled.count()
    assert slim.count() < bars.count() / 4
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (slim, shuffled)]
    assert "BroadcastHashJoin" in plans[0] and "hashpartitioning" not in plans[0]


def test_dense_hot_ticker(spark):
    """One ticker with a bar every second: the blocks stay linear."""
    n = 200_000
    bars = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("T"), F.col("id") % 50)).alias("ticker"),
        F.timestamp_seconds(F.col("id") + 1_700_000_000).alias("time_stamp"),
        (F.col("id") % 17).cast("double").alias("high"), (F.col("id") % 5).cast("double").alias("low"),
        (F.col("id") % 11).cast("double").alias("close"), (F.col("id") % 7).alias("volume"))
    got = indicators(bars, span=20_000, step_seconds=1, part_seconds=40_000)
    row = got.agg(F.count("*").alias("n"), F.sum("sma").alias("s")).head()
    ids = pd.Series(range(0, n, 3))
    assert row["n"] == n
    hot = got.filter("ticker = 'HOT'").orderBy("time_stamp").select("sma").toPandas()["sma"]
    volume = ids % 7
    expected = [volume[(ids >= i - 20_000) & (ids <= i)].mean() for i in (0, 30_000, 150_000)]
    assert [hot[i // 3] for i in (0, 30_000, 150_000)] == pytest.approx(expected)


@pytest.mark.parametrize("part_rows", [1 << 20, 40, 3])
def test_lag_over_parts_by_time(spark, part_rows):
    """A hot key, rows without a time, a burst in one second, and keys that skip parts."""
    rng = random.Random(part_rows)
    rows = [("hot", i * 7, i) for i in range(300)] + [("burst", 1000, 1000 + i) for i in range(30)]
    rows += [("far", s, 2000 + s) for s in (0, 1, 2000, 2099)] + [("none", None, 3000 + i) for i in range(3)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "key string, sec long, id long")
    found = lag_by_key(df, ["key"], ["sec", "id"], {"before": "id"}, part_rows=part_rows)
    wanted = {}
    for key in ("hot", "burst", "far", "none"):
        own = sorted((s is not None, s or 0, i) for k, s, i in rows if k == key)
        wanted |= {b[2]: a[2] for a, b in zip(own, own[1:])} | {own[0][2]: None}
    assert {r["id"]: r["before"] for r in found.collect()} == wanted
