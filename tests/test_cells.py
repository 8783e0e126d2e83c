"""Dense series by cells: a task sorts cells, and frames are those of the whole series."""

import random

import pytest
from pyspark.sql import functions as F

from barloom.operators.rolling import cell_rolling, previous_by_cells


@pytest.mark.parametrize("span", [60, 97, 100])      # 97 is prime: one cell a span
def test_frames_of_cells_are_frames_of_rows(spark, span):
    random.seed(span)
    seconds = sorted(random.sample(range(-500, 1500), 260))
    rows = [(k, s, random.choice([None, float(random.randint(-9, 9))])) for k in ("a", None) for s in seconds]
    df = spark.createDataFrame(rows, "k string, sec long, v double")
    got = cell_rolling(df, ["k"], "sec", span, {"total": ("sum", "v"), "n": ("count", "v"), "mean": ("avg", "v")}).collect()
    assert len(got) == len(rows)
    for r in got:
        held = [v for k, s, v in rows if k == r["k"] and r["sec"] - span <= s <= r["sec"] and v is not None]
        assert r["n"] == len(held) and r["total"] == (sum(held) if held else None)
        assert r["mean"] == (pytest.approx(sum(held) / len(held)) if held else None)


def test_the_row_before_across_empty_cells(spark):
    rows = [("a", 1, 1.0), ("a", 2, None), ("a", 300, 3.0), ("a", 301, 4.0), ("b", 5, 9.0), (None, 7, 5.0), (None, 900, 6.0)]
    df = spark.createDataFrame(rows, "k string, sec long, v double")
    got = {(r["k"], r["sec"]): r["before"] for r in previous_by_cells(df, ["k"], "sec", "v", "before", 50).collect()}
    assert got == {("a", 1): None, ("a", 2): 1.0, ("a", 300): None, ("a", 301): 3.0, ("b", 5): None,
                   (None, 7): None, (None, 900): 5.0}


def test_no_task_holds_months_of_a_ticker(spark):
    """One ticker, 40 cells: the framed rows stand in many partitions, which parts of half a year would put in one."""
    df = spark.range(4000).select(F.lit("a").alias("k"), (F.col("id") * 10).alias("sec"), F.lit(1.0).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = cell_rolling(df, ["k"], "sec", 30_000, {"n": ("count", "v")})
        held = got.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(held) >= 4 and max(r["count"] for r in held) < 2500
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
