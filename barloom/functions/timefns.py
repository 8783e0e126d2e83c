"""Time expressions. Bad text becomes null; sessions run in UTC."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def clean_timestamp(text: Column) -> Column:
    """ISO text -> ``yyyy-MM-dd HH:mm:ss`` text: ``T`` becomes a space, the fraction is cut."""
    return F.regexp_replace(F.regexp_replace(text, "T", " "), r"\..*$", "")


def parse_timestamp(text: Column) -> Column:
    """Timestamp of the text, cut to the second; null when it cannot be read."""
    return F.date_trunc("second", F.try_to_timestamp(text))


def session_timestamp(day: Column, time_of_day: Column) -> Column:
    """Trading date and time-of-day text as one timestamp; a null time gives midnight."""
    return F.try_to_timestamp(F.concat_ws(" ", F.date_format(day, "yyyy-MM-dd"), time_of_day))


def epoch_seconds(ts: Column) -> Column:
    return F.unix_seconds(ts.cast("timestamp"))


def day_bound(day: Column, zone: str = "UTC") -> Column:
    """Midnight of a ``yyyy-MM-dd`` text in ``zone``, as epoch seconds."""
    return F.unix_seconds(F.to_utc_timestamp(F.try_to_timestamp(day, F.lit("yyyy-MM-dd")), zone))


def is_weekend(ts: Column) -> Column:
    return F.weekday(ts) > 4


def year_quarter(as_of: Column) -> tuple[Column, Column]:
    return F.year(as_of).alias("year"), F.quarter(as_of).alias("quarter")


def last_days(ts: Column, as_of: Column, days: int = 30) -> Column:
    """True for rows at or after ``as_of`` minus ``days``."""
    return ts >= as_of - F.make_dt_interval(F.lit(days))
