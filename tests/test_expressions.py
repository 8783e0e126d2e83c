from datetime import date, datetime

import pytest
from pyspark.sql import functions as F, types as T

from barloom.functions import timefns as tf
from barloom.operators.conform import conform, empty, flatten, pack, sample_keys, shared_columns
from barloom.operators.payload import (
    decode_array, decode_object, decode_wrapped, quarantine, tickers_of_master_list)
from barloom.model import BAR_ROW, ENDPOINTS, MASTER_LIST


def one(spark, *columns):
    return spark.range(1).select(*columns).head()


def test_times(spark):
    iso = F.lit("2024-01-02T09:15:03.789Z")
    row = one(
        spark, tf.clean_timestamp(iso).alias("text"), tf.parse_timestamp(iso).alias("parsed"),
        tf.parse_timestamp(F.lit("never")).alias("bad"),
        tf.session_timestamp(F.lit(date(2024, 1, 2)), F.lit("09:15:03")).alias("at"),
        tf.session_timestamp(F.lit(date(2024, 1, 2)), F.lit(None).cast("string")).alias("midnight"),
        tf.day_bound(F.lit("1970-01-02")).alias("utc"),
        tf.day_bound(F.lit("1970-01-02"), "Asia/Tokyo").alias("tokyo"),
        tf.day_bound(F.lit("02.01.1970")).alias("unreadable"),
        *tf.year_quarter(F.lit(date(2024, 4, 1))),
        tf.is_weekend(F.lit(date(2024, 1, 5))).alias("friday"),
        tf.is_weekend(F.lit(date(2024, 1, 6))).alias("saturday"),
    )
    assert row["text"] == "2024-01-02 09:15:03"
    assert row["parsed"] == datetime(2024, 1, 2, 9, 15, 3) and row["bad"] is None
    assert row["at"] == datetime(2024, 1, 2, 9, 15, 3)
    assert row["midnight"] == datetime(2024, 1, 2)
    assert (row["utc"], row["tokyo"], row["unreadable"]) == (86400, 86400 - 9 * 3600, None)
    assert (row["year"], row["quarter"]) == (2024, 2)
    assert (row["friday"], row["saturday"]) == (False, True)


def test_last_days_includes_its_first_instant(spark):
    as_of = F.lit(datetime(2024, 3, 31)).cast("timestamp")
    kept = lambda ts: one(spark, tf.last_days(F.lit(ts).cast("timestamp"), as_of).alias("k"))["k"]
    assert kept(datetime(2024, 3, 1)) and not kept(datetime(2024, 2, 29, 23, 59, 59))


RATIO = ENDPOINTS["financial_ratio"].schema


def bodies(spark, *texts):
    return spark.createDataFrame([("AAA", t) for t in texts], "asked string, body string")


def test_array_with_prefix_keys_missing_keys_and_numbers(spark):
    text = ('[{"ticker":"AAA","quarter":1.0,"year":2024,"bookValuePerShare":10,'
            '"bookValuePerShareChange":0.5,"surprise":1},'
            '{"ticker":"AAA","quarter":null,"year":2024.5,"earningPerShare":9007199254740993}]')
    first, second = decode_array(bodies(spark, text), RATIO).collect()
    assert (first["book_value_per_share"], first["book_value_per_share_change"]) == (10.0, 0.5)
    assert (first["year"], first["quarter"], first["roe"]) == (2024, 1, None)
    assert (second["quarter"], second["year"]) == (None, None)
    assert second["earning_per_share"] == 9007199254740993


def test_empty_array(spark):
    df = bodies(spark, "[]", "broken", None)
    assert decode_array(df, RATIO, keep=["asked"]).count() == 0
    kept = decode_array(df, RATIO, keep=["asked"], outer=True).collect()
    assert [(r["asked"], r["ticker"]) for r in kept] == [("AAA", None)] * 3


def test_object(spark):
    schema = T.StructType([T.StructField("avgROE", T.DoubleType()),
                           T.StructField("noShares", T.IntegerType())])
    rows = decode_object(bodies(spark, '{"avgROE":25,"noShares":3000000000}', "{}"), schema)
    assert rows.columns == ["avg_ro_e", "no_shares"]
    assert [tuple(r) for r in rows.collect()] == [(25.0, None), (None, None)]


def test_wrapped(spark):
    text = ('{"ticker":"AAA","data":[{"open":10,"high":11.5,"low":9.5,"close":11,"volume":1200,'
            '"tradingDate":"2024-01-02T00:00:00.000Z"},{"open":1}]}')
    rows = decode_wrapped(bodies(spark, text, '{"ticker":"BBB","data":[]}'), BAR_ROW).collect()
    assert [(r["ticker"], r["open"], r["volume"]) for r in rows] == [
        ("AAA", 10.0, 1200), ("AAA", 1.0, None)]


def test_quarantine_splits_without_loss(spark):
    texts = ['{"a":1}', ' \n{"a":1}', '{"a":1', "[1]", "", None, "nonsense", '{"a":1} tail']
    good, bad = quarantine(bodies(spark, *texts), "object")
    assert [r["body"] for r in good.collect()] == texts[:2]
    assert [r["body"] for r in bad.collect()] == texts[2:]
    arrays, _ = quarantine(bodies(spark, *texts), "array")
    assert [r["body"] for r in arrays.collect()] == ["[1]"]


def test_master_list(spark):
    df = bodies(spark, '{"items":[{"ticker":"A","x":1},{"ticker":"B"}]}', '{"items":[{"ticker":"A"}]}')
    assert sorted(r[0] for r in tickers_of_master_list(df, MASTER_LIST).collect()) == ["A", "B"]


TARGET = T.StructType([T.StructField("b", T.LongType()), T.StructField("a", T.IntegerType()),
                       T.StructField("c", T.StringType())])


def test_conform(spark):
    df = spark.createDataFrame([("7", 2.9, "x"), ("text", 1e30, "y")], "a string, b double, extra string")
    with pytest.raises(ValueError, match="c"):
        conform(df, TARGET)
    rows = conform(df, TARGET, fill_missing=True)
    assert rows.schema.names == ["b", "a", "c"]
    assert [f.dataType for f in rows.schema] == [f.dataType for f in TARGET]
    assert [tuple(r) for r in rows.collect()] == [(2, 7, None), (None, None, None)]


def test_number_text_is_cast_as_spark_casts_it(spark):
    texts = ["7", " -7\t", "+7", "\x017", "7.0", "7a", "", "  ", "99999999999", "1e3", "NaN", "-Infinity",
             "inf", "1.5d", ".5", "5.", "abc", "0x1F", None]
    df = spark.createDataFrame([(t, t, t) for t in texts], "i string, l string, d string")
    target = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("l", T.LongType()),
                           T.StructField("d", T.DoubleType())])
    plain = df.select(*(F.col(f.name).try_cast(f.dataType).alias(f.name) for f in target))
    assert repr(conform(df, target).collect()) == repr(plain.collect())


def test_shared_columns_keep_the_order_of_the_table(spark):
    df = bodies(spark, None, '[{"roeGrowth":1,"c":2,"b":3},{"a":1}]')
    assert sample_keys(df) == ["a", "b", "c", "roeGrowth"]  # of all elements
    assert shared_columns(sample_keys(df), TARGET).names == [f.name for f in TARGET if f.name in "abc"]
    assert sample_keys(bodies(spark, '{"a":1}')) == ["a"]
    assert sample_keys(bodies(spark, None)) == []
    assert empty(spark, TARGET).schema == TARGET and empty(spark, TARGET).count() == 0


def test_flatten_and_pack(spark):
    df = spark.sql("select 1 as id, struct(2 as x, struct(3 as `y.z`) as inner) as s")
    assert [tuple(r) for r in flatten(df).collect()] == [(1, 2, 3)]
    assert flatten(df, prefix=True).columns == ["id", "s_x", "s_inner_y.z"]
    with pytest.raises(ValueError, match="id"):
        flatten(spark.sql("select 1 as id, struct(2 as id) as s"))
    packed = pack(df)
    assert packed.select(F.size("data_array").alias("n")).head()["n"] == 1
    assert packed.select(F.explode("data_array").alias("r")).select("r.*").schema == df.schema
