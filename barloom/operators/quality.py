"""Checks and repairs for what a relational store would enforce by constraints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from barloom.model import Table
from barloom.operators.ordering import first_per_key


def known_keys(columns: Sequence[str]) -> Column:
    """Whether no part of a key is null."""
    known = F.lit(True)
    for c in columns:
        known = known & F.col(c).isNotNull()
    return known


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(keys))


def null_key_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What :func:`drop_null_keys` leaves out."""
    return df.filter(~known_keys(keys))


def normalise_ticker(df: DataFrame, ticker: str = "ticker") -> DataFrame:
    return df.withColumn(ticker, F.upper(ticker))


def one_per_ticker(df: DataFrame, order: Sequence[str | Column],
                   ticker: str = "ticker") -> DataFrame:
    """Upper-case tickers, then the first row of each by ``order``."""
    return first_per_key(normalise_ticker(df, ticker), [ticker], order)


def pk_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once or have a null part, with their row count."""
    counted = df.groupBy(*keys).agg(F.count("*").alias("rows"))
    return counted.filter((F.col("rows") > 1) | ~known_keys(keys))


def fk_orphans(child: DataFrame, parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Child rows whose key is known but absent from the parent."""
    return (child.filter(known_keys(keys))
            .join(parent.select(*keys), list(keys), "left_anti"))


def text_violations(df: DataFrame, widths: dict[str, int],
                    required: Sequence[str] = ()) -> DataFrame:
    """One row per broken rule: the row's columns, `column` and `problem`."""
    problems = [
        F.when(F.length(c) > n, F.struct(F.lit(c).alias("column"), F.lit("too long").alias("problem")))
        for c, n in widths.items()
    ] + [
        F.when(F.col(c).isNull(), F.struct(F.lit(c).alias("column"), F.lit("null").alias("problem")))
        for c in required
    ]
    found = F.array_compact(F.array(*problems))
    return df.withColumn("_p", F.explode(found)).select(*df.columns, "_p.*")


def table_violations(df: DataFrame, table: Table) -> DataFrame:
    return text_violations(df, table.widths, table.required)


def cascade_delete(child: DataFrame, removed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The child rows that stay when the parents in ``removed`` go."""
    return child.join(removed.select(*keys), list(keys), "left_anti")


def surviving_children(child: DataFrame, parents: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The child rows of the parents that are left, and those that refer to none."""
    left = parents.select(*keys).distinct().withColumn("_parent", F.lit(True))
    return child.join(left, list(keys), "left").filter(
        F.col("_parent") | ~known_keys(keys)).select(*child.columns)


def only_new(df: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not stored yet."""
    return df.join(existing.select(*keys), list(keys), "left_anti")


def idempotent_rows(df: DataFrame, existing: DataFrame, keys: Sequence[str],
                    order: Sequence[str | Column]) -> DataFrame:
    """What an append may add: one row per key, the first by ``order``, and no stored key.

    Copies go first, map-side, so that the join meets every key once and keeps its partitioning.
    """
    return only_new(first_per_key(df, keys, order), existing, keys)
