"""Technical indicators per ticker.

The formulas follow the stored table on purpose, odd as they are: the mean is that of the volume,
the bands are centred on the volume with the upper one below, the deviation is divided by a fixed
30, and the flow uses ``1 - ratio``. Columns, span and divisor are parameters.

Bars are unique per ticker and second, as the key of the bar table demands. ``step_seconds`` says
how dense they are: a day for the stored bars, 1 for bars at any second.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from barloom.functions.timefns import epoch_seconds
from barloom.operators.ordering import latest_per_key
from barloom.operators.rolling import (
    CELL_SECONDS, DAY_SECONDS, MONTH_SECONDS, cell_rolling, floor_to, is_sparse, previous_by_cells, range_frame)
from barloom.session import BROADCAST_ROWS, broadcast_if_small, settle

OUTPUT = ["ticker", "time_stamp", "sma", "lower_bollinger", "higher_bollinger", "money_flow"]


def typical_price() -> Column:
    return (F.col("high") + F.col("low") + F.col("close")) / 3


def _flow_index(ratio: Column) -> Column:
    return 100 - F.try_divide(F.lit(100.0), 1 - ratio)


def _compute(bars: DataFrame, span: int, divisor: float, average: str, step_seconds: int,
             part_seconds: int) -> DataFrame:
    """All intermediate columns; what a caller does not select is pruned from the plan.

    Daily bars need one exchange and one sort by ticker. Denser series are written and framed by cells of a
    day or so (:func:`cell_rolling`), so that a task sorts cells and not months of a ticker.
    """
    series = bars.select(
        "ticker", "time_stamp", epoch_seconds(F.col("time_stamp")).alias("sec"),
        F.col("close").cast("double"), F.col(average).cast("double").alias("level"),
        typical_price().alias("typical_price"),
    )
    by, now, last = ["ticker"], F.col("typical_price"), F.col("lag_typical_price")
    level = {"sma": ("avg", "level")}
    if is_sparse(span, step_seconds):
        framed = range_frame
        previous = F.lag("typical_price").over(Window.partitionBy(*by).orderBy("sec"))
        mean = framed(series.withColumn("lag_typical_price", previous), by, "sec", span, level)
    else:
        framed = cell_rolling
        series = previous_by_cells(settle(series, "series"), by, "sec", "typical_price", "lag_typical_price", part_seconds)
        mean = settle(framed(settle(series, "previous"), by, "sec", span, level), "means")
    signed = mean.withColumns({
        "distance": F.pow(F.col("close") - F.col("sma"), 2),
        "positive": F.when(last < now, now).otherwise(F.lit(0.0)),
        "negative": F.when(last > now, now).otherwise(F.lit(0.0)),
    })
    summed = framed(signed, by, "sec", span, {
        "distance_sum": ("sum", "distance"),
        "positive_sum": ("sum", "positive"), "negative_sum": ("sum", "negative"),
    })
    deviation = F.sqrt(F.col("distance_sum") / divisor)
    ratio = F.try_divide("positive_sum", "negative_sum")
    return summed.select(
        "ticker", "time_stamp", "sma", "distance", deviation.alias("deviation"),
        (F.col("level") + deviation).alias("lower_bollinger"),
        (F.col("level") - deviation).alias("higher_bollinger"),
        "typical_price", "lag_typical_price", "positive", "negative", ratio.alias("ratio"),
        _flow_index(ratio).alias("money_flow"),
    )


def bollinger_bands(bars: DataFrame, span: int = MONTH_SECONDS, divisor: float = 30,
                    average: str = "volume", step_seconds: int = DAY_SECONDS,
                    part_seconds: int = CELL_SECONDS) -> DataFrame:
    """Mean, deviation and the two bands."""
    return _compute(bars, span, divisor, average, step_seconds, part_seconds).select(
        "ticker", "time_stamp", "sma", "distance", "deviation", "lower_bollinger",
        "higher_bollinger")


def money_flow(bars: DataFrame, span: int = MONTH_SECONDS, step_seconds: int = DAY_SECONDS,
               part_seconds: int = CELL_SECONDS) -> DataFrame:
    """Typical price, its rises and falls, their ratio and the flow index."""
    return _compute(bars, span, 30, "volume", step_seconds, part_seconds).select(
        "ticker", "time_stamp", "typical_price", "lag_typical_price", "positive", "negative",
        "ratio", "money_flow")


def indicators(bars: DataFrame, span: int = MONTH_SECONDS, divisor: float = 30,
               average: str = "volume", step_seconds: int = DAY_SECONDS,
               part_seconds: int = CELL_SECONDS) -> DataFrame:
    """The stored indicators of every bar."""
    return _compute(bars, span, divisor, average, step_seconds, part_seconds).select(*OUTPUT)


def look_back(bars: DataFrame, wanted: DataFrame, span: int = MONTH_SECONDS) -> DataFrame:
    """``(ticker, first)`` to ``(ticker, first, reach)``: the second that a ticker's bars are needed from.

    Indicators from second ``first`` on need two spans before it, rounded down to a whole span, and
    the one bar before those for the previous price. Reads tickers and times only.
    """
    start = floor_to(F.col("first") - 2 * span, span)
    timed = bars.select("ticker", epoch_seconds(F.col("time_stamp")).alias("sec"))
    earlier = timed.join(wanted, "ticker").filter(F.col("sec") < start).groupBy("ticker").agg(
        F.max("sec").alias("earlier"))
    return wanted.join(earlier, "ticker", "left").select(
        "ticker", "first", F.coalesce("earlier", start).alias("reach"))


def recent_bars(bars: DataFrame, span: int = MONTH_SECONDS,
                broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The bars that the newest row of each ticker depends on.

    That is two spans before the newest bar, rounded down to a whole span, and the one bar before
    those for the previous price. The bounds come from tickers and times alone, by a summary of one
    row per ticker and span, which is settled first: if the tickers are few enough, older bars are
    dropped before any exchange, by a condition of the join. All months are read.
    """
    sec = epoch_seconds(F.col("time_stamp"))
    spans = bars.groupBy("ticker", floor_to(sec, span).alias("_span")).agg(F.max(sec).alias("_last"))
    newest = F.max("_last").over(Window.partitionBy("ticker"))
    started = spans.withColumn("_start", floor_to(newest - 2 * span, span))
    before = F.max(F.when(F.col("_span") < F.col("_start"), F.col("_last")))
    bounds = started.groupBy("ticker").agg(F.coalesce(before, F.min("_start")).alias("_from"))
    few = broadcast_if_small(bounds, broadcast_rows)
    return bars.join(few, "ticker").filter(sec >= F.col("_from")).select(*bars.columns)


def tail_of(bars: DataFrame, span: int = MONTH_SECONDS) -> DataFrame:
    """The same bars as :func:`recent_bars`, for series that a task can hold: their bounds are windows over the
    ticker, so that all that follows goes by one exchange."""
    sec, own = epoch_seconds(F.col("time_stamp")), Window.partitionBy("ticker")
    timed = bars.withColumn("_sec", sec).withColumn("_newest", F.max("_sec").over(own)).withColumn(
        "_start", floor_to(F.col("_newest") - 2 * span, span))
    earlier = F.max(F.when(F.col("_sec") < F.col("_start"), F.col("_sec"))).over(own)
    return timed.withColumn("_from", F.coalesce(earlier, "_start")).filter("_sec >= _from").select(*bars.columns)


def latest_indicators(bars: DataFrame, span: int = MONTH_SECONDS, step_seconds: int = DAY_SECONDS,
                      **options) -> DataFrame:
    """The indicators of the newest bar per ticker, from a bounded look-back."""
    kept = tail_of(bars, span) if is_sparse(span, step_seconds) else recent_bars(bars, span)
    recent = indicators(kept, span, step_seconds=step_seconds, **options)
    return latest_per_key(recent, ["ticker"], "time_stamp")


def affected_rows(marked: DataFrame, span: int = MONTH_SECONDS) -> DataFrame:
    """Of bars with ``missing`` (their indicators were never computed) those whose indicators may have changed.

    A bar counts in the means of one span after it, and those means in the deviations of one span more. The next
    bar, however late, has a new previous price, which counts for one span after that bar.
    """
    sec, order = epoch_seconds(F.col("time_stamp")), Window.partitionBy("ticker").orderBy("_sec")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    return (marked.withColumn("_sec", sec)
            .withColumn("_next", F.lag("missing").over(order))
            .withColumns({"_late": F.max(F.when(F.col("missing"), F.col("_sec"))).over(so_far),
                          "_follows": F.max(F.when(F.col("_next"), F.col("_sec"))).over(so_far)})
            .filter((F.col("_sec") - F.col("_late") <= 2 * span) | (F.col("_sec") - F.col("_follows") <= span))
            .select("ticker", "time_stamp", "missing"))
