"""Compare queries with DuckDB: python tests/compare.py [sf] [name ...]"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from __spark_entry__ import oracle_sql, queries  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def session(cpus: int = 8) -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cpus}]")
             .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return connection


def _plain(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    return sorted(tuple("null" if pd.isna(v) else f"{float(v):.9g}" if isinstance(v, (int, float))
                        and not isinstance(v, bool) else str(v) for v in row)
                  for row in df.itertuples(index=False, name=None))


def differences(spark_rows: pd.DataFrame, oracle_rows: pd.DataFrame) -> str:
    if sorted(spark_rows.columns) != sorted(oracle_rows.columns):
        return f"columns {sorted(spark_rows.columns)} != {sorted(oracle_rows.columns)}"
    left, right = _plain(spark_rows), _plain(oracle_rows)
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            return f"{sum(x != y for x, y in zip(left, right))} rows differ, first {a} != {b}"
    return ""


def main() -> None:
    folder = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    names = sys.argv[2:] or list(queries())
    spark, connection = session(), duck(folder)
    failed = 0
    for name in names:
        started = time.time()
        try:
            df = queries()[name](spark, folder)
            rows = df.toPandas()
            took = time.time() - started
            found = connection.execute(oracle_sql()[name])
            types = {d[0]: str(d[1]) for d in found.description}
            problem = differences(rows, found.df())
            kinds = {c: (t, types.get(c)) for c, t in df.dtypes}
        except Exception as error:  # noqa: BLE001 - report and go on
            took, problem, kinds, rows = time.time() - started, str(error)[:1500], {}, []
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {len(rows)} rows {took:.1f}s {problem}",
              flush=True)
        if os.environ.get("TYPES"):
            print("     ", kinds)
    print("failed:", failed)


if __name__ == "__main__":
    main()
