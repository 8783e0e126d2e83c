from pyspark.sql import functions as F

from barloom.model import TABLES
from barloom.operators.conform import conform
from barloom.operators.quality import (
    cascade_delete, drop_null_keys, fk_orphans, idempotent_rows, one_per_ticker, only_new,
    pk_violations, surviving_children, table_violations)


def frame(spark, rows):
    return spark.createDataFrame(rows, "ticker string, year int, x double")


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_keys(spark):
    df = frame(spark, [("A", 1, 1.0), ("A", 1, 2.0), ("A", 2, 3.0), (None, 1, 4.0), ("B", None, 5.0)])
    assert values(pk_violations(df, ["ticker", "year"])) == [("A", 1, 2), ("B", None, 1), (None, 1, 1)]
    assert drop_null_keys(df, ["ticker", "year"]).count() == 3


def test_orphans_and_deletes_leave_unknown_keys_alone(spark):
    child = frame(spark, [("A", 1, 1.0), ("B", 1, 2.0), (None, 1, 3.0)])
    parent = frame(spark, [("A", 0, 0.0), ("A", 9, 9.0), (None, 0, 0.0)])
    gone = parent.filter("ticker = 'A'")
    assert values(fk_orphans(child, parent, ["ticker"])) == [("B", 1, 2.0)]
    assert values(cascade_delete(child, gone, ["ticker"])) == [("B", 1, 2.0), (None, 1, 3.0)]
    assert values(surviving_children(child, parent, ["ticker"])) == [("A", 1, 1.0), (None, 1, 3.0)]


def test_text_rules(spark):
    table = TABLES["listing_companies"]
    rows = frame(spark, [("TOOLONGTICKER", 1, 0.0), (None, 1, 0.0), ("FINE", 1, 0.0)]).withColumn(
        "exchange", F.lit("SIXSIX"))
    found = table_violations(conform(rows, table.schema, fill_missing=True), table)
    assert values(found.select("ticker", "column", "problem")) == [
        ("FINE", "exchange", "too long"), ("TOOLONGTICKER", "exchange", "too long"),
        ("TOOLONGTICKER", "ticker", "too long"), (None, "exchange", "too long"),
        (None, "ticker", "null")]


def test_one_per_ticker_ignores_case(spark):
    df = frame(spark, [("abc", 2, 1.0), ("ABC", 1, 2.0), ("Abc", 3, 3.0), ("x", 1, 4.0)])
    assert values(one_per_ticker(df, ["year"])) == [("ABC", 1, 2.0), ("X", 1, 4.0)]


def test_appending_twice_adds_nothing(spark):
    stored = frame(spark, [("A", 1, 1.0)])
    new = frame(spark, [("A", 1, 9.0), ("B", 1, 5.0), ("B", 1, 4.0), ("B", 2, 6.0)])
    fresh = idempotent_rows(new, stored, ["ticker", "year"], ["x"])
    assert values(fresh) == [("B", 1, 4.0), ("B", 2, 6.0)]
    assert idempotent_rows(new, stored.union(fresh), ["ticker", "year"], ["x"]).isEmpty()
    assert values(only_new(new, stored, ["ticker"])) == [("B", 1, 4.0), ("B", 1, 5.0), ("B", 2, 6.0)]


def test_one_key_with_most_rows(spark):
    """Two thirds of the rows have one key, a third one key and year."""
    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 < 2, "HOT").otherwise(F.concat(F.lit("T"), F.col("id"))).alias("ticker"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).cast("int").alias("year"),
        F.col("id").cast("double").alias("x"))
    assert values(pk_violations(df, ["ticker", "year"])) == [("HOT", 1, n // 3 + 1)]
    assert one_per_ticker(df, ["x"]).count() == n // 3 + 1
    parents = df.filter("ticker <> 'HOT'")
    assert fk_orphans(df, parents, ["ticker"]).count() == 2 * n // 3
    assert cascade_delete(df, df.filter("ticker = 'HOT'"), ["ticker"]).count() == n // 3
    assert idempotent_rows(df, parents, ["ticker", "year"], ["x"]).count() == n // 3
