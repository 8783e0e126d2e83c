"""Trailing time windows per key, at a cost that grows with the rows and not with the frame.

A frame holds the rows of one key whose epoch second lies in ``[t - span, t]``. What is known about
the series (``step_seconds``, the least distance of two rows of a key) decides how it is computed:

* sparse, such as daily bars: Spark's own range frame. A frame has a few dozen rows and a whole
  series a few hundred a year, so neither can grow hot;
* dense, unique per second: :func:`spread` cuts a series into parts by time, with an overlap that
  covers the look-back, so a hot key becomes many tasks, and :func:`block_rolling` cuts a part into
  blocks as long as the frame. A frame is then the tail of one block plus the head of the next, and
  both are running sums. Spark's own frame adds all its rows again for every row, which is
  quadratic here. Nothing is subtracted, so no precision is lost to earlier, larger values;
* any rows (``step_seconds=0``): summed per second first, then as above.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from barloom.operators.ordering import carried_rows
from barloom.session import broadcast_if_small

MONTH_SECONDS = 2_629_800  # fixed value: 30.4375 days
PART_SECONDS = 6 * MONTH_SECONDS
DAY_SECONDS = 86_400
SPARSE_FRAME_ROWS = 64
#: At most so many cells make a frame.
CELLS = 30
CELL_SECONDS = MONTH_SECONDS // CELLS


def is_sparse(span: int, step_seconds: int) -> bool:
    """True if a frame can hold no more than a few dozen rows."""
    return step_seconds > 0 and span // step_seconds < SPARSE_FRAME_ROWS


def floor_to(value: Column, step: int) -> Column:
    """Largest multiple of ``step`` not above ``value``, in whole numbers."""
    return value - F.pmod(value, F.lit(step).cast("bigint"))


def spread(df: DataFrame, keys: Sequence[str], sec: str, look_back: int,
           part_seconds: int = PART_SECONDS, carry: bool = False) -> DataFrame:
    """Copy rows into all parts (`_part`) whose frames may reach back to them.

    `_own` marks the one copy that belongs to the part. With ``carry`` each part also gets the row
    that precedes its first one, however long ago, so that ``lag`` is right after a gap.
    A part holds at most ``part_seconds + look_back`` rows of a key, its seconds being unique.
    """
    first = floor_to(F.col(sec), part_seconds)
    last = floor_to(F.col(sec) + look_back, part_seconds)
    parts = F.explode(F.sequence(first, last, F.lit(part_seconds).cast("bigint")))
    copies = df.select("*", parts.alias("_part")).withColumn("_own", F.col("_part") == first)
    if not carry:
        return copies
    marks = df.select("*", first.alias("_first"), last.alias("_last"))
    extra = carried_rows(marks, keys, [sec], part_seconds)
    return copies.unionByName(extra.withColumn("_own", F.lit(False)))


def block_rolling(df: DataFrame, by: Sequence[str], sec: str, span: int,
                  outputs: dict[str, tuple[str, str]]) -> DataFrame:
    """Add ``{name: ("sum" | "avg" | "count", column)}`` over ``[t - span, t]`` within ``by``."""
    length = span + 1
    offset = F.pmod(sec, F.lit(length).cast("bigint"))
    start = F.col(sec) - offset
    blocks = df.select("*", offset.alias("_off"),
                       F.explode(F.array(start, start + length)).alias("_block"))
    in_head = F.col("_block") + F.col("_off") == F.col(sec)
    group = Window.partitionBy(*by, "_block")
    # head rows up to t, and rows of the block before that are less than a frame old
    head = group.orderBy("_off").rangeBetween(Window.unboundedPreceding, 0)
    tail = group.orderBy(F.col("_off").desc()).rangeBetween(Window.unboundedPreceding, -1)

    running = {}
    for kind, column in outputs.values():
        if kind in ("sum", "avg"):
            running[f"_sum_{column}"] = (F.sum, column)
        if kind in ("count", "avg"):
            running[f"_count_{column}"] = (F.count, column)
    sums = {f"{name}_h": aggregate(F.when(in_head, F.col(c))).over(head)
            for name, (aggregate, c) in running.items()}
    sums |= {f"{name}_t": aggregate(F.when(~in_head, F.col(c))).over(tail)
             for name, (aggregate, c) in running.items()}

    def total(name: str) -> Column:
        h, t = F.col(f"{name}_h"), F.col(f"{name}_t")
        return F.coalesce(h + t, h, t)

    def result(kind: str, column: str) -> Column:
        if kind == "avg":
            return F.try_divide(total(f"_sum_{column}"), total(f"_count_{column}"))
        return total(f"_{kind}_{column}")

    framed = blocks.withColumns(sums).filter(in_head)
    return framed.select(*df.columns, *(result(kind, column).alias(name)
                                        for name, (kind, column) in outputs.items()))


def cell_rolling(df: DataFrame, keys: Sequence[str], sec: str, span: int,
                 outputs: dict[str, tuple[str, str]]) -> DataFrame:
    """The same as :func:`block_rolling` for whole series, by cells that are a whole fraction of the span.

    A frame is the tail of one cell, the head of another and the whole cells between, whose sums are made map-side
    and summed by cell. A task sorts cells, each of a thirtieth of the seconds of a frame, whatever the series holds.
    ``df`` is read twice, so it should be written. Rows without a second are left out.
    """
    n = next(k for k in range(CELLS, 0, -1) if span % k == 0)
    length = span // n
    offset = F.pmod(sec, F.lit(length).cast("bigint"))
    start = F.col(sec) - offset
    running = {}
    for kind, column in outputs.values():
        if kind in ("sum", "avg"):
            running[f"_sum_{column}"] = (F.sum, column)
        if kind in ("count", "avg"):
            running[f"_count_{column}"] = (F.count, column)
    cells = df.filter(F.col(sec).isNotNull()).groupBy(*keys, start.alias("_cell")).agg(
        *(aggregate(c).alias(name) for name, (aggregate, c) in running.items()))
    between = Window.partitionBy(*keys).orderBy("_cell").rangeBetween(-(n - 1) * length, -length)
    whole = broadcast_if_small(cells.select(
        *(F.col(k).alias(f"_k_{k}") for k in keys), "_cell",
        *((F.sum(name).over(between) if n > 1 else F.lit(None).cast("double")).alias(f"{name}_m") for name in running)))

    blocks = df.select("*", offset.alias("_off"), F.explode(F.array(start, start + span)).alias("_block"))
    in_head = F.col("_block") + F.col("_off") == F.col(sec)
    group = Window.partitionBy(*keys, "_block")
    head = group.orderBy("_off").rangeBetween(Window.unboundedPreceding, 0)
    # the row of the same place of the cell a span before is as old as a frame may reach
    tail = group.orderBy(F.col("_off").desc()).rangeBetween(Window.unboundedPreceding, 0)
    sums = {f"{name}_h": aggregate(F.when(in_head, F.col(c))).over(head)
            for name, (aggregate, c) in running.items()}
    sums |= {f"{name}_t": aggregate(F.when(~in_head, F.col(c))).over(tail)
             for name, (aggregate, c) in running.items()}
    framed = blocks.withColumns(sums).filter(in_head)
    match = [framed[k].eqNullSafe(whole[f"_k_{k}"]) for k in keys] + [framed["_block"] == whole["_cell"]]

    def total(name: str) -> Column:
        known = F.array_compact(F.array(*(F.col(f"{name}_{part}") for part in "tmh")))
        return F.when(F.size(known) > 0, sum((F.coalesce(F.col(f"{name}_{part}"), F.lit(0)) for part in "mh"),
                                             F.coalesce(F.col(f"{name}_t"), F.lit(0))))

    def result(kind: str, column: str) -> Column:
        if kind == "avg":
            return F.try_divide(total(f"_sum_{column}"), total(f"_count_{column}"))
        return total(f"_{kind}_{column}")

    return framed.join(whole, match, "left").select(
        *df.columns, *(result(kind, column).alias(name) for name, (kind, column) in outputs.items()))


def previous_by_cells(df: DataFrame, keys: Sequence[str], sec: str, column: str, name: str,
                      length: int = CELL_SECONDS) -> DataFrame:
    """``column`` of the row before within ``keys``, for rows unique by second: within cells of ``length``
    seconds, and for the first of a cell from the last of the nearest cell before. ``df`` is read twice."""
    cell = floor_to(F.col(sec), length)
    ends = df.filter(F.col(sec).isNotNull()).groupBy(*keys, cell.alias("_cell")).agg(
        F.max_by(column, sec).alias("_end"))
    before = F.lag("_end").over(Window.partitionBy(*keys).orderBy("_cell")).alias("_before")
    handed = broadcast_if_small(ends.select(*(F.col(k).alias(f"_k_{k}") for k in keys), "_cell", before))
    own = df.withColumn("_place", cell)
    by_time = Window.partitionBy(*keys, "_place").orderBy(sec)
    within = own.withColumns({"_row": F.row_number().over(by_time), "_last": F.lag(column).over(by_time)})
    match = [within[k].eqNullSafe(handed[f"_k_{k}"]) for k in keys] + [within["_place"] == handed["_cell"]]
    value = F.when(F.col("_row") == 1, F.col("_before")).otherwise(F.col("_last"))
    return within.join(handed, match).select(*df.columns, value.alias(name))


def range_frame(df: DataFrame, by: Sequence[str], sec: str, span: int,
                outputs: dict[str, tuple[str, str]]) -> DataFrame:
    """The same as :func:`block_rolling` by Spark's range frame, for sparse series."""
    frame = Window.partitionBy(*by).orderBy(sec).rangeBetween(-span, 0)
    functions = {"sum": F.sum, "avg": F.avg, "count": F.count}
    return df.withColumns({name: functions[kind](column).over(frame)
                           for name, (kind, column) in outputs.items()})


def rolling(df: DataFrame, keys: Sequence[str], sec: str, outputs: dict[str, tuple[str, str]],
            span: int = MONTH_SECONDS, step_seconds: int = 0,
            part_seconds: int = PART_SECONDS) -> DataFrame:
    """Framed ``sum`` / ``avg`` / ``count`` per key.

    Rows without a second are peers of each other and of no other row. Rows of one second are peers and share their result. With ``step_seconds=0`` they are summed
    per second (map-side) and the results joined back, which bounds a part by its seconds whatever
    the number of rows.
    """
    if is_sparse(span, step_seconds):
        return range_frame(df, keys, sec, span, outputs)
    timeless = _timeless(df.filter(F.col(sec).isNull()), keys, outputs)
    df = df.filter(F.col(sec).isNotNull())
    if step_seconds > 0:
        parts = spread(df, keys, sec, span, part_seconds)
        return (block_rolling(parts, [*keys, "_part"], sec, span, outputs)
                .filter("_own").drop("_own", "_part")).unionByName(timeless)

    columns = list(dict.fromkeys(c for _, c in outputs.values()))
    cells = df.groupBy(*keys, sec).agg(
        *(F.sum(c).alias(f"_s_{c}") for c in columns),
        *(F.count(c).alias(f"_n_{c}") for c in columns),
    )
    running = {f"_r{p}_{c}": ("sum", f"_{p}_{c}") for c in columns for p in "sn"}
    framed = block_rolling(spread(cells, keys, sec, span, part_seconds), [*keys, "_part"], sec,
                           span, running).filter("_own")
    picks = {
        "sum": lambda c: F.col(f"_rs_{c}"),
        "count": lambda c: F.col(f"_rn_{c}"),
        "avg": lambda c: F.try_divide(F.col(f"_rs_{c}"), F.col(f"_rn_{c}")),
    }
    results = framed.select(
        *(F.col(k).alias(f"_k_{k}") for k in (*keys, sec)),
        *(picks[kind](c).alias(name) for name, (kind, c) in outputs.items()),
    )
    match = [df[k].eqNullSafe(results[f"_k_{k}"]) for k in (*keys, sec)]
    framed_rows = df.join(results, match, "left").drop(*(f"_k_{k}" for k in (*keys, sec)))
    return framed_rows.unionByName(timeless)


def _timeless(df: DataFrame, keys: Sequence[str], outputs: dict[str, tuple[str, str]]) -> DataFrame:
    """Rows without a second, each with the totals of those of its key."""
    functions = {"sum": F.sum, "avg": F.avg, "count": F.count}
    totals = df.groupBy(*(F.col(k).alias(f"_k_{k}") for k in keys)).agg(
        *(functions[kind](column).alias(name) for name, (kind, column) in outputs.items()))
    match = [df[k].eqNullSafe(totals[f"_k_{k}"]) for k in keys]
    return df.join(totals, match).drop(*(f"_k_{k}" for k in keys))


def rolling_ratio(df: DataFrame, keys: Sequence[str], sec: str, above: str, below: str,
                  name: str = "ratio", **options) -> DataFrame:
    """Ratio of two framed sums; null when the lower one is zero."""
    sums = {"_above": ("sum", above), "_below": ("sum", below)}
    return (
        rolling(df, keys, sec, sums, **options)
        .withColumn(name, F.try_divide("_above", "_below"))
        .drop("_above", "_below")
    )
