"""The same tables in a relational database, by Spark's JDBC source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from barloom.functions.timefns import last_days


def read_options(url: str, table: str, split: tuple[str, str, str, int] | None = None,
                 **connection: str) -> dict[str, str]:
    """Options of a scan. ``split`` is (column, lower, upper, tasks) for a parallel read."""
    options = {"url": url, "dbtable": table, **connection}
    if split:
        column, lower, upper, tasks = split
        options |= {"partitionColumn": column, "lowerBound": lower, "upperBound": upper,
                    "numPartitions": str(tasks)}
    return options


def write_options(url: str, table: str, overwrite: bool = False, batch: int = 10_000,
                  connections: int = 16, **connection: str) -> dict[str, str]:
    """Options of a write. An overwrite empties the table and keeps its keys."""
    options = {"url": url, "dbtable": table, "batchsize": str(batch),
               "numPartitions": str(connections), **connection}
    if overwrite:
        options |= {"truncate": "true", "cascadeTruncate": "true"}
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**read_options(url, table, **options)).load()


def jdbc_schema(spark: SparkSession, url: str, table: str, **options) -> StructType:
    """The schema of a table; no row is fetched."""
    return read_jdbc(spark, url, table, **options).schema


def trailing_jdbc(spark: SparkSession, url: str, table: str, as_of: Column, days: int = 30,
                  ts: str = "time_stamp", **options) -> DataFrame:
    """Rows of the last ``days``; the filter runs in the database."""
    return read_jdbc(spark, url, table, **options).filter(last_days(F.col(ts), as_of, days))


def write_jdbc(df: DataFrame, url: str, table: str, overwrite: bool = False, **options) -> None:
    """Append or overwrite.

    A retried task sends its rows again: have the table's key reject copies, or load a staging
    table and move it in one statement.
    """
    chosen = write_options(url, table, overwrite, **options)
    df.write.format("jdbc").options(**chosen).mode("overwrite" if overwrite else "append").save()
