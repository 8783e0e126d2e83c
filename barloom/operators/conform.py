"""Bring a frame to a declared schema."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from barloom.functions.naming import snake_name


# What number text must look like at least. A failing cast raises and catches an error inside Spark,
# some twenty microseconds a row, so text that cannot be a number is not tried.
_WHOLE_TEXT = r"^[\s\p{Cntrl}]*[-+]?[0-9]+[\s\p{Cntrl}]*$"
_REAL_TEXT = r"[0-9]|(?i:inf|nan)"


def conform(df: DataFrame, schema: T.StructType, fill_missing: bool = False) -> DataFrame:
    """The schema's columns, in its order and types, in one projection.

    A value that does not fit its type becomes null. A missing column is an error unless
    ``fill_missing`` asks for nulls.
    """
    present = {c.lower() for c in df.columns}
    missing = [f.name for f in schema if f.name.lower() not in present]
    if missing and not fill_missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*(
        F.lit(None).cast(f.dataType).alias(f.name) if f.name in missing
        else _fitted(df, f).alias(f.name) for f in schema
    ))


def _fitted(df: DataFrame, target: T.StructField) -> Column:
    actual = next(f.dataType for f in df.schema if f.name.lower() == target.name.lower())
    column = F.col(f"`{target.name}`")
    if actual == target.dataType:
        return column
    fitted = column.try_cast(target.dataType)
    if isinstance(actual, T.StringType) and isinstance(target.dataType, T.NumericType):
        whole = isinstance(target.dataType, T.IntegralType)
        return F.when(column.rlike(_WHOLE_TEXT if whole else _REAL_TEXT), fitted)
    return fitted


def shared_columns(names: Iterable[str], schema: T.StructType) -> T.StructType:
    """The fields of ``schema`` that a payload with these keys fills, in the schema's order."""
    sent = {snake_name(name) for name in names}
    return T.StructType([f for f in schema if f.name in sent])


def sample_keys(bodies: DataFrame, body: str = "body") -> list[str]:
    """The keys of all payloads: of objects, and of every element of arrays.

    A distinct of names, combined map-side; only names reach the driver.
    """
    text = F.trim(body)
    elements = F.when(text.startswith("["), F.from_json(text, "array<string>")).otherwise(F.array(text))
    keys = bodies.select(F.explode(elements).alias("e")).select(
        F.explode(F.json_object_keys("e")).alias("key")).distinct()
    return sorted(r["key"] for r in keys.collect())


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def flatten(df: DataFrame, prefix: bool = False) -> DataFrame:
    """All leaves of nested structs as columns; ``prefix`` keeps the path in the name."""

    def leaves(schema: T.StructType, path: tuple[str, ...]) -> list[tuple[str, ...]]:
        found = []
        for f in schema:
            here = (*path, f.name)
            found += leaves(f.dataType, here) if isinstance(f.dataType, T.StructType) else [here]
        return found

    paths = leaves(df.schema, ())
    names = ["_".join(p) if prefix else p[-1] for p in paths]
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ValueError(f"equal leaf names: {repeated}; use prefix=True")
    return df.select(*(F.col(".".join(f"`{part}`" for part in path)).alias(name)
                       for path, name in zip(paths, names)))


def pack(df: DataFrame, name: str = "data_array") -> DataFrame:
    """All columns of a row as a one-element array of structs."""
    return df.select(F.array(F.struct(*(F.col(f"`{c}`") for c in df.columns))).alias(name))
