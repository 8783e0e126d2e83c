"""The tables as Parquet tables of a catalog database.

Bars and indicators are kept by the quarter of their timestamp (hidden column ``p_quarter``), trades by its day
(``p_date``), ratings by their ``year``, so that refreshes read and write few files. Bars and indicators may be
bucketed by ticker too: windows per ticker over stored rows then need no exchange. Tables that are
replaced whole are not partitioned: a replacement is written to a fresh folder, and one change of the
catalog puts it in place of the old one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from barloom.functions.timefns import last_days
from barloom.model import STATEMENTS, TABLES, Table
from barloom.operators.conform import conform
from barloom.operators.quality import drop_null_keys, idempotent_rows, known_keys, only_new
from barloom.session import observed, plain_numbers, settle

HIDDEN_QUARTER, HIDDEN_DATE = "p_quarter", "p_date"
#: Tables that loads replace whole.
REPLACED = (*STATEMENTS, "companies_info")
#: Tables whose windows go by ticker, which :func:`create_tables` can bucket.
SERIES = ("stock_history", "derived_stock_history")
#: The next free number of each numbered table; rows are only added, the highest counts.
MARKS = "id_marks"
#: What no load could use, kept beside the tables: bodies that cannot be read, rows without a key.
#: One table per dataset, as loads run side by side.
REJECTS = "rejects_"
REJECT_COLUMNS = ["dataset", "ticker", "reason", "content"]


def _partition_column(table: Table) -> str | None:
    if table.year_of:
        return HIDDEN_DATE if table.name == "stock_intraday_transaction" else HIDDEN_QUARTER
    return "year" if "year" in table.columns and table.name not in REPLACED else None


def quarter_of(ts: Column) -> Column:
    """The year and the first month of the quarter as one number, such as 202404."""
    return F.year(ts) * 100 + F.quarter(ts) * 3 - 2


def _partition_value(table: Table) -> Column:
    """What a row's partition column holds."""
    by = _partition_column(table)
    if by == HIDDEN_QUARTER:
        return quarter_of(F.col(table.year_of))
    return F.col(table.year_of).cast("date") if by == HIDDEN_DATE else F.col(by)


def _written(schema: T.StructType) -> dict[str, str]:
    """How the files of a table are written."""
    return {"compression": "zstd", **plain_numbers(schema)}


def create_tables(spark: SparkSession, db: str, location: str | None = None,
                  names: Iterable[str] = TABLES, buckets: int = 0) -> None:
    """The database and its tables, where they are not there yet.

    With ``buckets`` the rows of the series are dealt by ticker into so many files per quarter, each in order.
    """
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{place}")
    for name in names:
        table = TABLES[name]
        columns = [f"{f.name} {f.dataType.simpleString()}" for f in table.schema]
        by = _partition_column(table)
        if table.year_of:
            columns.append(f"{by} {'int' if by == HIDDEN_QUARTER else 'date'}")
        layout = f" PARTITIONED BY ({by})" if by else ""
        if buckets and name in SERIES:
            layout += f" CLUSTERED BY (ticker) SORTED BY ({', '.join(table.key)}) INTO {buckets} BUCKETS"
        written = ", ".join(f"'{k}' = '{v}'" for k, v in _written(table.schema).items())
        spark.sql(f"CREATE TABLE IF NOT EXISTS {db}.{name} ({', '.join(columns)}) "
                  f"USING parquet OPTIONS ({written}){layout}")


def _described(spark: SparkSession, db: str, name: str) -> dict[str, str]:
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {db}.{name}").collect()}


def buckets_of(spark: SparkSession, db: str, name: str) -> int:
    """Into how many buckets a table is dealt, 0 if it is not."""
    return int(_described(spark, db, name).get("Num Buckets", 0))


def truncate_tables(spark: SparkSession, db: str, names: Iterable[str] = TABLES) -> None:
    for name in names:
        spark.sql(f"TRUNCATE TABLE {db}.{name}")


def drop_tables(spark: SparkSession, db: str, names: Iterable[str] = TABLES) -> None:
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {db}.{name}")


def read_table(spark: SparkSession, db: str, name: str) -> DataFrame:
    """All rows, in the declared column order."""
    return spark.table(f"{db}.{name}").select(*TABLES[name].columns)


def table_schema(spark: SparkSession, db: str, name: str):
    """The stored schema; no row is read."""
    return read_table(spark, db, name).schema


def trailing_rows(spark: SparkSession, db: str, name: str, as_of: Column,
                  days: int = 30) -> DataFrame:
    """Rows of the last ``days`` before ``as_of``; older quarters are not read."""
    table = TABLES[name]
    first = quarter_of(as_of - F.make_dt_interval(F.lit(days)))
    return (spark.table(f"{db}.{name}").filter(F.col(HIDDEN_QUARTER) >= first)
            .filter(last_days(F.col(table.year_of), as_of, days)).select(*table.columns))


def rows_since(spark: SparkSession, db: str, name: str, first: datetime) -> DataFrame:
    """The rows from a moment on; earlier quarters are not read."""
    table = TABLES[name]
    return spark.table(f"{db}.{name}").filter(
        (F.col(HIDDEN_QUARTER) >= first.year * 100 + first.month - (first.month - 1) % 3)
        & (F.col(table.year_of) >= F.lit(first))).select(*table.columns)


def rows_of_quarters(spark: SparkSession, db: str, name: str, wanted: DataFrame) -> DataFrame:
    """The rows of some tickers in some quarters: ``wanted`` has ``ticker`` and ``p_quarter``, few enough rows to be
    broadcast. Quarters that no ticker asks for are not read, as the join prunes partitions when it runs."""
    return (spark.table(f"{db}.{name}").join(wanted, ["ticker", HIDDEN_QUARTER], "left_semi")
            .select(*TABLES[name].columns))


def session_rows(spark: SparkSession, db: str, name: str, day: date) -> DataFrame:
    """The trades of one day; other days are not read."""
    return spark.table(f"{db}.{name}").filter(F.col(HIDDEN_DATE) == F.lit(day)).select(*TABLES[name].columns)


def _insert(df: DataFrame, db: str, name: str, overwrite: bool = False, dealt: bool = False) -> None:
    """Add rows, or replace all rows by them. Rows that are ``dealt`` into parts of a good size stay in them."""
    table = TABLES[name]
    rows, by = conform(df, table.schema), _partition_column(table)
    if by:
        rows = rows.withColumn(by, _partition_value(table))
        buckets = buckets_of(df.sparkSession, db, name) if name in SERIES else 0
        # one file per bucket and quarter; else adaptive rebalancing splits a large partition and joins
        # small ones, without a sampling pass
        if buckets:
            rows = rows.repartition(buckets, "ticker")
        elif not dealt:
            rows = rows.hint("rebalance", by)
        rows = rows.sortWithinPartitions(by, *table.key)
        rows = rows.select(*(c for c in rows.columns if c != by), by)
    rows.write.insertInto(f"{db}.{name}", overwrite=overwrite)


def append(df: DataFrame, db: str, name: str, dealt: bool = False) -> None:
    _insert(df, db, name, dealt=dealt)


def _switch(spark: SparkSession, db: str, name: str, path: str) -> None:
    """Let a table read another folder from now on, by one change of the catalog."""
    spark.sql(f"ALTER TABLE {db}.{name} SET LOCATION '{path}'")


def overwrite(df: DataFrame, db: str, name: str) -> None:
    """Replace all rows; the table and its layout stay. ``df`` may read the table itself.

    A table that is not partitioned is written to a fresh folder beside the old one, which readers see until
    the catalog names the new one: who stops in between has changed nothing. Of a partitioned table, the
    rows are written aside first.
    """
    table = TABLES[name]
    if _partition_column(table):
        _insert(settle(conform(df, table.schema), name), db, name, overwrite=True)
    else:
        replace_folder(conform(df, table.schema), db, name)


def replace_folder(rows: DataFrame, db: str, name: str) -> None:
    """Write ``rows`` to a fresh folder and put it in place of a table's old one."""
    path = write_beside(rows, db, name)
    _switch(rows.sparkSession, db, name, path)


def write_beside(rows: DataFrame, db: str, name: str) -> str:
    """Write ``rows`` to a fresh folder beside a table's own, which the table does not read yet."""
    path = f"{_described(rows.sparkSession, db, name)['Location'].rsplit('/', 1)[0]}/{name}-{uuid.uuid4().hex}"
    rows.write.options(**_written(rows.schema)).parquet(path)
    return path


def put_in_place(spark: SparkSession, db: str, name: str, path: str, more: DataFrame | None = None) -> None:
    """Let a table read the rows of :func:`write_beside` from now on, and those of ``more``, which are added first."""
    if more is not None:
        more.write.options(**_written(more.schema)).mode("append").parquet(path)
    _switch(spark, db, name, path)


def replace_partitions(df: DataFrame, db: str, name: str) -> None:
    """Replace the rows of those partitions that ``df`` has rows of; all others stay."""
    conf, mode = df.sparkSession.conf, "spark.sql.sources.partitionOverwriteMode"
    rows, before = settle(conform(df, TABLES[name].schema), name), conf.get(mode)
    conf.set(mode, "dynamic")        # for this write; a table of this kind heeds no option of the writer
    try:
        _insert(rows, db, name, overwrite=True)
    finally:
        conf.set(mode, before)


#: A replacement computed from the table itself.
rewrite = overwrite


def side_table(spark: SparkSession, db: str, name: str, columns: str) -> DataFrame:
    """A table that loads keep for themselves, made when it is first asked for."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {db}.{name} ({columns}) USING parquet")
    return spark.table(f"{db}.{name}")


def reject(rows: DataFrame, db: str, name: str) -> None:
    """Keep ``dataset, ticker, reason, content`` rows; what is kept already is not kept again."""
    spark = rows.sparkSession
    columns = ", ".join(f"{c} string" for c in REJECT_COLUMNS)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {db}.{REJECTS}{name} ({columns}) USING parquet")
    known = spark.table(f"{db}.{REJECTS}{name}").select(*(F.col(c).alias(f"_{c}") for c in REJECT_COLUMNS))
    match = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in REJECT_COLUMNS]
    rows.select(*REJECT_COLUMNS).distinct().join(known, match, "left_anti").write.insertInto(
        f"{db}.{REJECTS}{name}")


def rejects(spark: SparkSession, db: str) -> DataFrame:
    """What the loads of all datasets have kept aside."""
    kept = spark.createDataFrame([], ", ".join(f"{c} string" for c in REJECT_COLUMNS))
    for found in spark.catalog.listTables(db):
        if found.name.startswith(REJECTS):
            kept = kept.unionByName(spark.table(f"{db}.{found.name}"))
    return kept


@dataclass(frozen=True)
class Sent:
    """Rows written aside for a load, and what was counted while they were written."""

    rows: DataFrame
    sent: int
    null_keys: int
    first: object = None       # least and greatest value of the partition column
    last: object = None


def settled_rows(rows: DataFrame, keys: Iterable[str], name: str, part: Column | None = None) -> Sent:
    """Write ``rows`` aside once; the pass that writes counts those without a whole key and finds the
    range of ``part``."""
    seen, known = Observation(), known_keys(list(keys))
    part = F.lit(None).cast("int") if part is None else part
    counted = rows.observe(seen, F.count(F.lit(1)).alias("sent"), F.count_if(~known).alias("null_keys"),
                            F.min(part).alias("first"), F.max(part).alias("last"))
    return Sent(settle(counted, name), **observed(seen, sent=0, null_keys=0))


def counted_rows(rows: DataFrame, keys: Iterable[str]) -> Sent:
    """:func:`settled_rows` of rows that are made of what is written aside already: a pass over their keys counts them,
    and they are not written again."""
    known = known_keys(list(keys))
    return Sent(rows, *rows.agg(F.count(F.lit(1)), F.count_if(~known)).head())


def keyed_rows(sent: Sent, keys: Iterable[str], db: str, name: str) -> DataFrame:
    """The rows that have a whole key; the others, if any were counted, go to the rejects."""
    keys = list(keys)
    if not sent.null_keys:
        return sent.rows
    bad = sent.rows.filter(~known_keys(keys))
    reject(bad.select(F.lit(name).alias("dataset"), F.col("ticker"), F.lit("null key").alias("reason"),
                      F.to_json(F.struct(*bad.columns)).alias("content")), db, name)
    return drop_null_keys(sent.rows, keys)


@dataclass(frozen=True)
class Appended:
    """What an append was given, left out for want of a key, and added; the rest was stored or repeated."""

    sent: int
    null_keys: int
    added: int

    @property
    def repeated(self) -> int:
        return self.sent - self.null_keys - self.added


def append_new(df: DataFrame, db: str, name: str, unique: bool = False,
               near: bool = True, before: Callable[[DataFrame], None] | None = None,
               within: tuple | None = None, dealt: bool = False) -> Appended:
    """Append the rows whose key is not stored; running it again adds nothing.

    Rows without a whole key go to the rejects. ``unique`` says that ``df`` has no two rows of one
    key, which saves looking for them. With ``near`` the rows are written aside once, their time
    range and faults are found in that pass, and other stored partitions are left unread; without it, for
    rows that cover most of what is stored, nothing is written aside and rows without a key are left out.
    So it is for rows whose partitions the caller knows to lie ``within`` two values, but then others are not
    read. ``before`` gets the rows that are about to be appended, written aside. Rows of one partition that the join leaves
    ``dealt`` into parts of a good size are not shuffled again to be written. All counts come from the passes that write.
    """
    table = TABLES[name]
    rows, by = conform(df, table.schema), _partition_column(table)
    stored = df.sparkSession.table(f"{db}.{name}")
    near = near and within is None
    if near:
        sent = settled_rows(rows, table.key, name, _partition_value(table) if by else None)
        rows, within = keyed_rows(sent, table.key, db, name), (sent.first, sent.last)
    else:
        counted = Observation()
        rows = drop_null_keys(rows.observe(counted, F.count(F.lit(1)).alias("sent"), F.count_if(
            ~known_keys(table.key)).alias("null_keys")), table.key)
    if by and within:
        stored = stored.limit(0) if within[0] is None else stored.filter(F.col(by).between(*map(F.lit, within)))
    if unique:
        fresh = only_new(rows, stored, table.key)
    else:
        others = [c for c in rows.columns if c not in table.key]
        fresh = idempotent_rows(rows, stored, table.key, others)
    if before:
        fresh = settle(fresh, name)
        before(fresh)
    written = Observation()
    append(fresh.observe(written, F.count(F.lit(1)).alias("added")), db, name, dealt=dealt)
    seen = {"sent": sent.sent, "null_keys": sent.null_keys} if near else observed(counted, sent=0, null_keys=0)
    return Appended(**seen, **observed(written, added=0))


def write_both(df: DataFrame, db: str, targets: dict[str, tuple[DataFrame, str]]) -> None:
    """Write several tables made from one frame, which is kept until all are written."""
    df.persist()
    try:
        for name, (rows, mode) in targets.items():
            {"append": append, "overwrite": overwrite, "append_new": append_new}[mode](rows, db, name)
    finally:
        df.unpersist()


def take_ids(spark: SparkSession, db: str, count: int, name: str = "stock_intraday_transaction") -> int:
    """Take the next ``count`` numbers of a table and return the first of them.

    They are noted as taken before any row is written, so no two loads get the same; a load that fails
    afterwards leaves a gap. The numbered table itself is read only if nothing was noted yet.
    """
    marks = side_table(spark, db, MARKS, "table_name string, next bigint").filter(F.col("table_name") == name)
    start = marks.agg(F.max("next")).head()[0]
    if start is None:
        highest = spark.table(f"{db}.{name}").agg(F.max("id")).head()[0]
        start = 0 if highest is None else highest + 1
    spark.createDataFrame([(name, start + count)], "table_name string, next bigint").write.insertInto(f"{db}.{MARKS}")
    return start
