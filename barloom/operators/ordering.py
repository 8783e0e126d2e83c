"""Global order without a global task: dense ids, previous row, first row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from barloom.session import settle

#: Rows of a part that a series is cut into, and how many times as many one may hold.
PART_ROWS = 1 << 20
MOST_PART = 8
_POSITION_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def _columns(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def _ranged(df: DataFrame, order: Sequence[str | Column], partitions: int | None) -> DataFrame:
    """Range-partitioned and sorted rows with their place (`_range`, `_pos`).

    Ranges are cut on the whole order tuple, so a hot key is spread over many of them. The result
    is settled: a second evaluation would sample other range bounds.
    """
    columns = _columns(order)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = (
        df.repartitionByRange(n, *columns)
        .sortWithinPartitions(*columns)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    return settle(placed, "ranged").withColumns({
        "_range": F.shiftright("_place", _POSITION_BITS),
        "_pos": F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)),
    }).drop("_place")


def ordered_id(df: DataFrame, order: Sequence[str | Column], name: str = "id", start: int = 0,
               partitions: int | None = None) -> DataFrame:
    """Dense, increasing bigint ids that follow ``order`` (which should be unique)."""
    placed = _ranged(df, order, partitions)
    # one row per range, however large the data
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_range").agg(F.count("*").alias("_rows"))
        .select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        placed.join(F.broadcast(offsets), "_range")
        .withColumn(name, F.lit(start) + F.col("_offset") + F.col("_pos"))
        .drop("_range", "_pos", "_offset")
    )


def carried_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], step: int) -> DataFrame:
    """Rows to add so that every part of a series also holds the row just before its first one.

    ``df`` has the numbers of the first and last part that hold a row (`_first`, `_last`, both
    multiples of ``step`` and rising with ``order``). The last row of each part is reduced map-side
    and goes to those parts of its successor that do not hold it already: one summary row per key
    and non-empty part, whatever the number of rows.
    """
    values = [c for c in df.columns if c not in (*keys, "_first", "_last")]
    rank = F.struct(*order) if len(order) > 1 else F.col(order[0])
    last_rows = df.groupBy(*keys, "_last").agg(
        F.min("_first").alias("_first"), *(F.max_by(c, rank).alias(c) for c in values)
    )
    return _handed_on(last_rows, keys, step)


def _handed_on(last_rows: DataFrame, keys: Sequence[str], step: int) -> DataFrame:
    """The last row of each part, for the parts of its successor that do not hold it already."""
    series = Window.partitionBy(*keys).orderBy("_last")
    return (
        last_rows.withColumns({
            "_next_first": F.lead("_first").over(series),
            "_next_last": F.lead("_last").over(series),
        })
        .filter(F.col("_next_last").isNotNull())
        .withColumn("_part", F.explode(F.sequence(
            F.greatest("_next_first", F.col("_last") + step), "_next_last",
            F.lit(step).cast("bigint"),
        )))
        .drop("_first", "_last", "_next_first", "_next_last")
    )


def lag_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: dict[str, str],
               partitions: int | None = None, part_rows: int = PART_ROWS) -> DataFrame:
    """Value of the previous row of the key: ``columns`` maps new name -> source column.

    One key may hold any share of the rows. Where the order begins with a time or a number, series are cut by it into
    parts of ``part_rows`` rows on average, each with the last row of the part before: one exchange of all
    rows. Where it does not, or a part holds far more rows than the others, or ``partitions`` asks for it, ranges
    of the whole order do the same with a sample and a settled copy.
    """
    kind = df.schema[order[0]].dataType
    if partitions or not isinstance(kind, (T.NumericType, T.TimestampType, T.TimestampNTZType, T.DateType)):
        return _lag_over_ranges(df, keys, order, columns, partitions)
    place = F.col(order[0]) if isinstance(kind, T.NumericType) else F.unix_micros(F.col(order[0]).cast("timestamp"))
    place = place.cast("double")
    low, high, rows = df.agg(F.min(place), F.max(place), F.count(F.lit(1))).head()
    parts = max(1, -(-rows // part_rows))
    if parts == 1 or low is None or low == high:
        whole = Window.partitionBy(*keys).orderBy(*order)
        if rows > MOST_PART * part_rows:
            return _lag_over_ranges(df, keys, order, columns, None)
        return df.withColumns({new: F.lag(old).over(whole) for new, old in columns.items()})
    # nulls come first in the order
    part = F.coalesce(F.floor((place - low) / ((high - low) / parts)), F.lit(-1)).cast("int").alias("_part")
    needed = list(dict.fromkeys([*keys, *order, *columns.values()]))
    last = F.max_by(F.struct(*needed), F.struct(*order)).alias("_row")
    ends = settle(df.select(*needed, part).groupBy(*keys, "_part").agg(last, F.count(F.lit(1)).alias("_rows")), "ends")
    if (ends.agg(F.max("_rows")).head()[0] or 0) > MOST_PART * part_rows:
        return _lag_over_ranges(df, keys, order, columns, None)
    extra = _handed_on(ends.select(*(F.col("_row")[c].alias(c) for c in needed), F.col("_part").alias("_first"),
                                   F.col("_part").alias("_last")), keys, 1).withColumn("_own", F.lit(False))
    own = df.select("*", part).withColumn("_own", F.lit(True))
    return _lagged(own, extra, keys, order, columns)


def _lagged(own: DataFrame, extra: DataFrame, keys: Sequence[str], order: Sequence[str],
            columns: dict[str, str]) -> DataFrame:
    """Previous values within parts, which ``extra`` rows begin."""
    series = Window.partitionBy(*keys, "_part").orderBy(*order)
    return (
        own.unionByName(extra, allowMissingColumns=True)
        .withColumns({new: F.lag(old).over(series) for new, old in columns.items()})
        .filter("_own").drop("_own", "_part")
    )


def _lag_over_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: dict[str, str],
                     partitions: int | None) -> DataFrame:
    """:func:`lag_by_key` by ranges of (keys, order), whatever their types and density."""
    placed = _ranged(df, [*keys, *order], partitions)
    needed = list(dict.fromkeys([*keys, *order, *columns.values()]))
    # a range is sorted, so its last row of a key is the one with the greatest position
    ends = placed.groupBy(*keys, "_range").agg(F.max("_pos").alias("_pos")).select("_range", "_pos")
    last_rows = placed.select(*needed, "_range", "_pos").join(ends, ["_range", "_pos"]).select(
        *needed, F.col("_range").alias("_first"), F.col("_range").alias("_last"))
    rows = placed.drop("_pos").withColumnRenamed("_range", "_part").withColumn("_own", F.lit(True))
    extra = _handed_on(last_rows, keys, 1).withColumn("_own", F.lit(False))
    return _lagged(rows, extra, keys, order, columns)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the first by ``order``.

    Spark turns the row-number filter into a group limit on both sides of the exchange, so each
    map task sends at most one row per key.
    """
    series = Window.partitionBy(*keys).orderBy(*_columns(order))
    return df.withColumn("_row", F.row_number().over(series)).filter("_row = 1").drop("_row")


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str,
                   ties: Sequence[str] = ()) -> DataFrame:
    """The newest row per key; ``ties`` (descending) make the choice unique."""
    return first_per_key(df, keys, [F.col(ts).desc(), *(F.col(c).desc() for c in ties)])


def ticker_sample(df: DataFrame, n: int = 3, order: str = "ticker") -> DataFrame:
    """The first ``n`` rows by ``order``: a stable small sample for trial runs."""
    return df.orderBy(order).limit(n)
