"""Every operator and load as a query over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from barloom.catalog import fixtures as fx
from barloom.functions.naming import snake_map, to_camel, to_snake
from barloom.functions.timefns import (
    clean_timestamp, day_bound, epoch_seconds, is_weekend, last_days, parse_timestamp,
    session_timestamp, year_quarter)
from barloom.model import ENDPOINTS, MASTER, MASTER_LIST, RATINGS, STATEMENTS, TABLES
from barloom.operators.conform import conform, empty, flatten, pack, sample_keys, shared_columns
from barloom.operators.ordering import lag_by_key, latest_per_key, ordered_id, ticker_sample
from barloom.operators.payload import (
    decode_array, decode_object, payload_types as types_of, quarantine, tickers_of_master_list)
from barloom.operators.quality import (
    cascade_delete, drop_null_keys, fk_orphans, normalise_ticker, one_per_ticker, only_new,
    pk_violations, surviving_children, text_violations)
from barloom.operators.rolling import DAY_SECONDS, rolling, rolling_ratio
from barloom.plans import indicators as ind, loads
from barloom.session import checkpoint, new_path, settle
from barloom.sources import store
from barloom.sources.requests import (
    archived, bar_requests, fetch, fetch_recorded, fetch_resumed, page_requests, recorded_requests, replay,
    request_grid, trade_requests)

AS_OF = date(2024, 2, 15)
LAST_BAR = "2001-11-04"
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register; results leave with zoneless timestamps, as the tables have them."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        df = function(spark, folder)
        zoned = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
        return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})

    run.__name__ = function.__name__
    QUERIES[function.__name__] = run
    return function


def rounded(df: DataFrame, digits: int = 8, **others: int) -> DataFrame:
    """Doubles cut to ``digits``, or to those named for a column."""
    return df.withColumns({f.name: F.round(f.name, others.get(f.name, digits)) for f in df.schema
                           if isinstance(f.dataType, T.DoubleType)})


def _timed_bars(spark: SparkSession, folder: str) -> DataFrame:
    return fx.bars(spark, folder).withColumn("sec", epoch_seconds(F.col("time_stamp")))


# Indicators -------------------------------------------------------------------------------------

@query
def indicators_full(spark, folder):
    return rounded(ind.indicators(fx.bars(spark, folder)), 4, sma=8)


@query
def indicators_latest(spark, folder):
    return rounded(ind.latest_indicators(fx.bars(spark, folder)), 4, sma=8)


@query
def indicators_dense(spark, folder):
    return rounded(ind.indicators(fx.second_bars(spark, folder), step_seconds=1), 4, sma=8)


@query
def bollinger_bands(spark, folder):
    return rounded(ind.bollinger_bands(fx.bars(spark, folder)), 4, sma=8)


@query
def money_flow(spark, folder):
    return rounded(ind.money_flow(fx.bars(spark, folder)), ratio=4, money_flow=4)


# Windows and order ------------------------------------------------------------------------------

@query
def rolling_month_avg(spark, folder):
    framed = rolling(_timed_bars(spark, folder), ["ticker"], "sec",
                     {"avg_volume": ("avg", "volume")}, step_seconds=DAY_SECONDS)
    return rounded(framed.select("ticker", "time_stamp", "avg_volume"))


@query
def rolling_month_sum(spark, folder):
    framed = rolling(_timed_bars(spark, folder), ["ticker"], "sec",
                     {"sum_volume": ("sum", "volume"), "days": ("count", "close")},
                     step_seconds=DAY_SECONDS)
    return framed.select("ticker", "time_stamp", "sum_volume", "days")


@query
def rolling_month_ratio(spark, folder):
    framed = rolling_ratio(_timed_bars(spark, folder), ["ticker"], "sec", "high", "low",
                           step_seconds=DAY_SECONDS)
    return rounded(framed.select("ticker", "time_stamp", "ratio"))


@query
def rolling_day_trades(spark, folder):
    """Any number of rows per second, few and hot keys."""
    timed = fx.trades(spark, folder).withColumn("sec", epoch_seconds(F.col("ts")))
    framed = rolling(timed, ["ticker"], "sec", {
        "sum_price": ("sum", "price"), "avg_k": ("avg", "k"), "trades": ("count", "price")},
        span=DAY_SECONDS)
    return rounded(framed.select("event_id", "ticker", "sum_price", "avg_k", "trades"), sum_price=4)


@query
def lag_by_key_bars(spark, folder):
    typical = fx.bars(spark, folder).select("ticker", "time_stamp",
                                            ind.typical_price().alias("typical_price"))
    return rounded(lag_by_key(typical, ["ticker"], ["time_stamp"],
                              {"lag_typical_price": "typical_price"}))


@query
def lag_by_key_trades(spark, folder):
    rows = fx.trades(spark, folder).select("ticker", "event_id", "ts", "price")
    return lag_by_key(rows, ["ticker"], ["ts", "event_id"],
                      {"last_price": "price", "last_event": "event_id"})


@query
def latest_trade(spark, folder):
    rows = latest_per_key(fx.trades(spark, folder), ["user_id"], "ts", ["event_id"])
    return rows.select("user_id", "event_id", "ts", "ticker", "price")


@query
def ordered_trade_id(spark, folder):
    rows = fx.trades(spark, folder).select("event_id", "ts")
    return ordered_id(rows, ["ts", "event_id"], name="id")


@query
def listing_sample(spark, folder):
    return ticker_sample(fx.listing(spark, folder).select("ticker", "exchange", "industry"), 3)


# Filters and times ------------------------------------------------------------------------------

@query
def trailing_days(spark, folder):
    rows = fx.bars(spark, folder)
    kept = rows.filter(last_days(F.col("time_stamp"), F.lit(LAST_BAR).cast("timestamp"), 30))
    return rounded(kept.select("ticker", "time_stamp", "close", "volume"))


@query
def weekend_rows(spark, folder):
    return fx.trades(spark, folder).filter(is_weekend(F.col("ts"))).select("event_id", "ts")


@query
def session_times(spark, folder):
    """Trading date and time of day; signups lack the time and fall on midnight."""
    time = F.when(F.col("ticker") != "signup", F.date_format("ts", "HH:mm:ss"))
    return fx.trades(spark, folder).select(
        "event_id", session_timestamp(F.lit(AS_OF), time).alias("time_stamp"))


@query
def cleaned_times(spark, folder):
    """ISO text with a fraction; the text of errors is damaged."""
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS")
    text = F.when(F.col("ticker") == "error", F.concat(F.lit("x"), iso)).otherwise(iso)
    return fx.trades(spark, folder).select(
        "event_id", clean_timestamp(text).alias("text"), parse_timestamp(text).alias("time_stamp"))


@query
def epoch_bounds(spark, folder):
    day = F.date_format("time_stamp", "yyyy-MM-dd")
    return fx.bars(spark, folder).select(
        "ticker", "time_stamp", epoch_seconds(F.col("time_stamp")).alias("sec"),
        day_bound(day).alias("day_start"), day_bound(day, "Asia/Tokyo").alias("tokyo_start"))


# Keys and quality -------------------------------------------------------------------------------

@query
def statements_clean(spark, folder):
    rows = normalise_ticker(drop_null_keys(fx.quarters(spark, folder),
                                           ["ticker", "year", "quarter"]))
    return rounded(rows.orderBy("ticker", F.desc("year"), F.desc("quarter")), 2)


@query
def rating_snapshot(spark, folder):
    """The first event per ticker, whatever its case, stamped with a fixed quarter."""
    mixed = F.when(F.col("k") > 50, F.lower("ticker")).otherwise(F.initcap("ticker"))
    rows = fx.trades(spark, folder).withColumn("ticker", F.concat(mixed, F.lit("-"), "user_id"))
    first = one_per_ticker(rows, ["ts", "event_id"])
    return first.select("ticker", "event_id", "price", *year_quarter(F.lit(AS_OF)))


@query
def new_listings(spark, folder):
    rows = fx.listing(spark, folder).select("ticker", "exchange", "industry")
    return only_new(rows, rows.filter("industry <> 'BUILDING'"), ["ticker"])


@query
def pk_violation_rows(spark, folder):
    return pk_violations(fx.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def fk_orphan_rows(spark, folder):
    parents = fx.table(spark, folder, "customer").filter("c_mktsegment <> 'MACHINERY'")
    orders = fx.table(spark, folder, "orders")
    return fk_orphans(orders.withColumnRenamed("o_custkey", "c_custkey"), parents, ["c_custkey"]) \
        .select("o_orderkey", "c_custkey", "o_totalprice")


@query
def text_violation_rows(spark, folder):
    rows = fx.table(spark, folder, "customer").select(
        "c_custkey", "c_name", F.nullif("c_mktsegment", F.lit("FURNITURE")).alias("segment"))
    return text_violations(rows, {"c_name": 256, "segment": 9}, ["c_name", "segment"])


@query
def cascade_delete_rows(spark, folder):
    orders = fx.table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("c_custkey"))
    removed = fx.table(spark, folder, "customer").filter("c_acctbal < 0")
    return cascade_delete(orders, removed, ["c_custkey"])


@query
def surviving_rows(spark, folder):
    orders = fx.table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("c_custkey"))
    return surviving_children(orders, fx.table(spark, folder, "customer").filter("c_acctbal >= 0"),
                              ["c_custkey"])


# Projection and schema --------------------------------------------------------------------------

@query
def flatten_nested(spark, folder):
    nested = fx.table(spark, folder, "orders").select(
        "o_orderkey", F.struct("o_custkey", F.struct("o_totalprice", "o_orderstatus").alias("sum"))
        .alias("body"))
    packed = pack(nested)
    rows = packed.select(F.explode("data_array").alias("row")).select("row.*")
    return flatten(rows)


@query
def flatten_with_paths(spark, folder):
    orders = fx.table(spark, folder, "orders")
    nested = orders.select(F.struct(F.col("o_orderkey").alias("key")).alias("order"),
                           F.struct(F.col("o_custkey").alias("key")).alias("customer"))
    return flatten(nested, prefix=True)


_ORDER_NAMES = {"orderKey": "o_orderkey", "totalPriceUSD": "o_totalprice", "avgROE": "o_custkey",
                "last5yearsEBITDAGrowth": "o_orderstatus"}


@query
def snake_names(spark, folder):
    camel = fx.table(spark, folder, "orders").select(
        *(F.col(c).alias(n) for n, c in _ORDER_NAMES.items()))
    there = to_snake(camel)
    return to_snake(to_camel(there, snake_map(camel.columns)))


_LINE_TARGET = T.StructType([
    T.StructField("flag", T.StringType()), T.StructField("order_key", T.StringType()),
    T.StructField("quantity", T.LongType()), T.StructField("status_code", T.IntegerType()),
    T.StructField("not_sent", T.DoubleType())])


@query
def conform_schema(spark, folder):
    """The columns a payload shares with a schema, then cast to it; text is no number."""
    rows = fx.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("orderKey"), F.col("l_quantity").alias("quantity"),
        F.col("l_linestatus").alias("statusCode"), F.col("l_returnflag").alias("flag"),
        F.col("l_tax").alias("unused"))
    keys = sample_keys(rows.select(F.to_json(F.struct("*")).alias("body")))
    return conform(to_snake(rows), shared_columns(keys, _LINE_TARGET))


@query
def conform_filled(spark, folder):
    rows = fx.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_key"), F.col("l_returnflag").alias("flag"))
    target = T.StructType(_LINE_TARGET.fields[:2] + _LINE_TARGET.fields[4:])
    return conform(rows, target, fill_missing=True)


@query
def requests(spark, folder):
    tickers = fx.listing(spark, folder).select("ticker")
    return request_grid(tickers, "balance_sheet")


@query
def requests_between(spark, folder):
    tickers = fx.listing(spark, folder).select("ticker")
    return bar_requests(tickers, "2000-01-01", "2001-01-01")


@query
def requests_of_session(spark, folder):
    """Each company asks for the day of one of its orders: weekends use another form."""
    days = fx.table(spark, folder, "orders").groupBy("o_custkey").agg(
        F.max("o_orderdate").alias("day"))
    names = fx.table(spark, folder, "customer").select(F.col("c_name").alias("ticker"), "c_custkey")
    dated = names.join(days, F.col("c_custkey") == F.col("o_custkey"))
    weekend = is_weekend(F.col("day"))
    monday, sunday = F.lit(date(2024, 2, 12)), F.lit(date(2024, 2, 11))
    return trade_requests(dated.filter(~weekend), monday).unionByName(
        trade_requests(dated.filter(weekend), sunday)).select("ticker", "path")


# Payloads ---------------------------------------------------------------------------------------

@query
def json_object(spark, folder):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("absent", T.StringType())])
    return decode_object(fx.table(spark, folder, "events"), schema, keep=["event_id"], body="props")


def _line_bodies(spark: SparkSession, folder: str) -> DataFrame:
    """An array of 0 to 6 elements from each line; whole numbers stand in double fields."""
    n = F.col("l_linenumber") - 1
    element = F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(
        i.alias("rowNo"), (F.col("l_quantity").cast("int") * i).alias("bookValue"),
        (F.col("l_extendedprice") * i).alias("bookValueChange"),
        F.lit("x").alias("unknownKey")))
    body = F.when(n > 0, F.to_json(element)).otherwise("[]")
    return fx.table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", body.alias("body"))


_LINE_ROW = T.StructType([
    T.StructField("rowNo", T.IntegerType()), T.StructField("bookValue", T.DoubleType()),
    T.StructField("bookValueChange", T.DoubleType())])


@query
def json_array_rows(spark, folder):
    return rounded(decode_array(_line_bodies(spark, folder), _LINE_ROW,
                                keep=["l_orderkey", "l_partkey"]), 4)


@query
def json_array_rows_outer(spark, folder):
    return rounded(decode_array(_line_bodies(spark, folder), _LINE_ROW,
                                keep=["l_orderkey", "l_partkey"], outer=True), 4)


@query
def json_wrapped_rows(spark, folder):
    return rounded(loads.daily_bars(fx.bar_bodies(spark, folder)))


@query
def json_quarantine(spark, folder):
    """Bodies of small numbers are cut short, those of 99 are arrays."""
    k = fx.trades(spark, folder).select("event_id", "k")
    whole = F.to_json(F.struct("k"))
    body = F.when(F.col("k") < 10, F.expr("substring(to_json(struct(k)), 1, 4)")) \
        .when(F.col("k") == 99, F.lit("[1]")).otherwise(whole)
    good, bad = quarantine(k.select("event_id", body.alias("body")), "object")
    return good.select("event_id", F.lit("good").alias("state")).unionByName(
        bad.select("event_id", F.lit("bad").alias("state")))


@query
def master_tickers(spark, folder):
    return tickers_of_master_list(fx.master_list_bodies(spark, folder), MASTER_LIST)


@query
def statement_rows(spark, folder):
    """Includes a key that is the beginning of another one."""
    rows = loads.statements(fx.statement_bodies(spark, folder, "financial_ratio"), "financial_ratio")
    return rounded(rows.select("ticker", "year", "quarter", "price_to_earning", "price_to_book",
                               "ebitda_on_stock_change", "book_value_per_share_change",
                               "credit_growth", "roe"), 2)


def _table_query(name: str) -> None:
    """All columns of a statement or rating table, from its bodies."""
    def rows(spark, folder):
        bodies = fx.bodies(spark, folder, name)
        made = loads.statements(bodies, name) if name in STATEMENTS else loads.ratings(bodies, name, AS_OF)
        return rounded(made, 2)

    rows.__name__ = f"table_{name}"
    query(rows)


for _name in (*STATEMENTS, *RATINGS):
    _table_query(_name)


@query
def rating_rows(spark, folder):
    rows = loads.ratings(fx.rating_bodies(spark, folder, "valuation_rating"), "valuation_rating",
                         AS_OF)
    return rounded(rows)


@query
def trade_rows(spark, folder):
    rows = loads.trades(fx.trade_bodies(spark, folder), AS_OF)
    return rounded(loads.numbered_trades(rows).drop("ba", "sa", "pcp"))


@query
def company_split(spark, folder):
    overview = loads.companies(fx.overview_bodies(spark, folder))
    listed = fx.listing(spark, folder).filter("industry = 'BUILDING'").select(
        F.upper("ticker").alias("ticker"))
    new, info = loads.split_companies(overview, listed)
    return rounded(
        new.select(F.lit("listing").alias("kind"), "ticker", F.col("short_name").alias("name"),
                   F.col("established_year").cast("double").alias("number"))
        .unionByName(info.select(F.lit("info").alias("kind"), "ticker",
                                 F.lit(None).cast("string").alias("name"),
                                 F.col("issue_share").alias("number"))))


# Sources, stores and loads ----------------------------------------------------------------------

@query
def fetch_landing(spark, folder):
    """Pages as recorded bodies, asked for one by one and landed."""
    archive = new_path(spark, "archive")
    fx.table(spark, folder, "pages").select(
        F.col("page_id").cast("string").alias("request_key"), F.col("url").alias("ticker"),
        F.lit(0).alias("flag"), F.col("html").alias("body")).write.options(**fx.RECORDED).parquet(archive)
    landed = fetch_recorded(spark, archive)
    return landed.select(F.col("request_key").cast("bigint").alias("page_id"),
                         F.col("ticker").alias("url"), F.col("body").alias("html"))


def _new_db(spark: SparkSession, buckets: int = 0) -> str:
    db = f"barloom_{uuid.uuid4().hex[:12]}"
    store.create_tables(spark, db, new_path(spark, db), buckets=buckets)
    return db

@query
def store_roundtrip(spark, folder):
    """Overwrite twice, then append: supplier balances in the info table."""
    db, name = _new_db(spark), "companies_info"
    rows = fx.table(spark, folder, "supplier").select(
        F.col("s_name").alias("ticker"), F.col("s_acctbal").alias("issue_share"),
        F.col("s_nationkey").alias("no_employees"))
    filled = conform(rows, TABLES[name].schema, fill_missing=True)
    store.overwrite(filled.filter("issue_share < 0"), db, name)
    store.overwrite(filled.filter("issue_share < 0"), db, name)
    store.append(filled.filter("issue_share >= 0"), db, name)
    return store.read_table(spark, db, name).select("ticker", "issue_share", "no_employees")


@query
def idempotent_append(spark, folder):
    """Two overlapping loads, the second one run twice."""
    db, name = _new_db(spark), "stock_history"
    bars = checkpoint(fx.bars(spark, folder))
    store.append_new(bars.filter("time_stamp < '1999-01-01'"), db, name)
    late = bars.filter("time_stamp >= '1998-01-01'")
    store.append_new(late.unionByName(late), db, name)
    store.append_new(late, db, name)
    return rounded(store.read_table(spark, db, name).select("ticker", "time_stamp", "close",
                                                            "volume"))


@query
def trailing_store(spark, folder):
    """The last 30 days of the stored bars: older years are not read."""
    db = _new_db(spark)
    store.append(fx.bars(spark, folder), db, "stock_history")
    rows = store.trailing_rows(spark, db, "stock_history", F.lit(LAST_BAR).cast("timestamp"))
    return rounded(rows.select("ticker", "time_stamp", "close", "volume"))


@query
def rewrite_after_delete(spark, folder):
    """A stored table replaced by what is left of it."""
    db, name = _new_db(spark), "stock_history"
    store.append(fx.bars(spark, folder), db, name)
    stored = store.read_table(spark, db, name)
    removed = fx.table(spark, folder, "part").groupBy(F.col("p_brand").alias("ticker")).agg(
        F.avg("p_size").alias("size")).filter("size > 25")
    store.rewrite(cascade_delete(stored, removed, ["ticker"]), db, name)
    return store.read_table(spark, db, name).groupBy("ticker").agg(
        F.count("*").alias("days"), F.sum("volume").alias("volume"))


@query
def table_lifecycle(spark, folder):
    """Fill two tables, empty one, drop the others: what the catalog holds afterwards."""
    db = _new_db(spark)
    store.append(fx.bars(spark, folder), db, "stock_history")
    rows = fx.listing(spark, folder).select("ticker", "exchange", "industry")
    store.append(conform(rows, TABLES["listing_companies"].schema, fill_missing=True), db,
                 "listing_companies")
    store.truncate_tables(spark, db, ["listing_companies"])
    kept = ["stock_history", "listing_companies"]
    store.drop_tables(spark, db, [name for name in TABLES if name not in kept])
    left = [t.name for t in spark.catalog.listTables(db)]
    return _table_counts(spark, db, left)


def _table_counts(spark: SparkSession, db: str, names) -> DataFrame:
    """Rows and one sum per table, each in its own scan."""
    total: dict[str, Column] = {
        "listing_companies": F.sum("established_year"), "companies_info": F.sum("issue_share"),
        "stock_history": F.sum("volume"), "derived_stock_history": F.sum("sma"),
        "stock_intraday_transaction": F.sum("volume")}
    counts = None
    for name in sorted(names):
        value = next(f.name for f in TABLES[name].schema if f.name not in ("ticker", "year", "quarter")
                     and not isinstance(f.dataType, T.StringType))
        one = store.read_table(spark, db, name).agg(
            F.lit(name).alias("table_name"), F.count("*").alias("rows"),
            F.round(total.get(name, F.sum(value)).cast("double"), 2).alias("total"))
        counts = one if counts is None else counts.unionByName(one)
    return counts


def _inbox(spark: SparkSession, folder: str, only: DataFrame | None = None) -> loads.Inbox:
    """Bodies by dataset, each landed once; with ``only``, those of its tickers, as a service is asked for no other."""
    landed: dict[str, str] = {}
    lists: list[DataFrame] = []
    making = Lock()       # loads run side by side

    def found_of(dataset: str) -> DataFrame:
        if dataset not in STATEMENTS:
            return fx.bodies(spark, folder, dataset)
        with making:      # the four statements are made of the same rows, which are grouped once
            if not lists:
                lists.append(settle(fx.statement_lists(spark, folder), "lists", compression="zstd"))
        return fx.statement_bodies(spark, folder, dataset, lists[0])

    def inbox(dataset: str) -> DataFrame:
        if dataset not in landed:
            found = found_of(dataset)
            if only is not None:
                found = found.join(F.broadcast(only.select("ticker").distinct()), "ticker", "left_semi").select(found.columns)
            landed[dataset] = new_path(spark, f"landed-{dataset}")
            found.write.option("compression", "zstd").parquet(landed[dataset])
        return spark.read.parquet(landed[dataset])

    return inbox


@query
def initial_load(spark, folder):
    db = _new_db(spark)
    loads.initial_load(spark, db, _inbox(spark, folder), AS_OF)
    return _table_counts(spark, db, [n for n in TABLES if n != "stock_intraday_transaction"])


@query
def quarterly_refresh(spark, folder):
    """Run twice for one quarter and once for the next: statements stay, ratings grow."""
    db, inbox = _new_db(spark), _inbox(spark, folder)
    loads.quarterly_refresh(spark, db, inbox, AS_OF)
    loads.quarterly_refresh(spark, db, inbox, AS_OF)
    loads.load_ratings(db, inbox, date(2024, 5, 15))
    return _table_counts(spark, db, ["listing_companies", "companies_info", "balance_sheet",
                                     "income_statement", "cash_flow", "financial_ratio", *RATINGS])


@query
def daily_refresh(spark, folder):
    """Run twice on one day, for the newest bars only: the second run finds nothing new."""
    db, inbox = _new_db(spark), _inbox(spark, folder)
    loads.daily_refresh(spark, db, inbox, AS_OF, catch_up=False)
    loads.daily_refresh(spark, db, inbox, AS_OF, catch_up=False)
    return _table_counts(spark, db, ["stock_history", "derived_stock_history",
                                     "stock_intraday_transaction"])


@query
def sample_run(spark, folder):
    """Initial load and daily refresh of three companies, three brands and two kinds of trades."""
    db = _new_db(spark)
    names = fx.listing(spark, folder).select("ticker")
    brands = fx.table(spark, folder, "part").select(F.col("p_brand").alias("ticker")).distinct()
    kinds = fx.trades(spark, folder).select("ticker").distinct()
    few = checkpoint(ticker_sample(names).unionByName(ticker_sample(brands)).unionByName(ticker_sample(kinds, 2)))
    loads.sample_run(spark, db, _inbox(spark, folder, few), few, AS_OF, n=8)
    return _table_counts(spark, db, TABLES)


# What goes wrong ----------------------------------------------------------------------------------

def _failing(inbox: loads.Inbox, ending: str = "7") -> loads.Inbox:
    """The same bodies, but an error page for the tickers with this ending."""
    fails = F.col("ticker").endswith(ending)
    return lambda name: inbox(name).withColumn(
        "body", F.when(fails, "<html>502</html>").otherwise(F.col("body")))


@query
def append_null_keys_twice(spark, folder):
    """Bars, some without a time, appended twice: what is stored, and what is kept aside."""
    db, name = _new_db(spark), "stock_history"
    bars = fx.bars(spark, folder).withColumn(
        "time_stamp", F.when(F.dayofmonth("time_stamp") % 7 != 0, F.col("time_stamp")))
    store.append_new(bars, db, name)
    store.append_new(bars, db, name)
    stored = store.read_table(spark, db, name).groupBy("ticker").agg(F.count("*").alias("bars"))
    aside = store.rejects(spark, db).groupBy("ticker").agg(F.countDistinct("content").alias("aside"))
    return stored.join(aside, "ticker")


@query
def statements_with_failed_bodies(spark, folder):
    """A second load in which some bodies are error pages loses no stored row."""
    db, inbox = _new_db(spark), _inbox(spark, folder)
    loads.load_statements(db, inbox)
    loads.load_statements(db, _failing(inbox))
    return _table_counts(spark, db, STATEMENTS)


@query
def companies_with_failed_bodies(spark, folder):
    db, inbox = _new_db(spark), _inbox(spark, folder)
    loads.load_companies(spark, db, inbox)
    loads.load_companies(spark, db, _failing(inbox))
    return _table_counts(spark, db, ["listing_companies", "companies_info"])


@query
def rejects_of_load(spark, folder):
    """The bodies kept aside by loads that ran twice."""
    db, inbox = _new_db(spark), _failing(_inbox(spark, folder))
    for _ in range(2):
        loads.load_companies(spark, db, inbox)
        loads.load_ratings(db, inbox, AS_OF)
    return store.rejects(spark, db).select("dataset", "ticker", "reason", "content")


@query
def shared_keys_all_bodies(spark, folder):
    """Keys that only some bodies, or only later elements of an array, have."""
    rows = fx.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("orderKey"), F.col("l_linestatus").alias("statusCode"),
        F.when(F.col("l_linenumber") > 1, F.col("l_returnflag")).alias("flag"),
        F.when(F.col("l_linenumber") > 2, F.col("l_quantity")).alias("quantity"), "l_linenumber")
    one = F.to_json(F.struct("orderKey", "flag"))
    many = F.concat(F.lit("["), F.to_json(F.struct("orderKey")), F.lit(","),
                    F.to_json(F.struct("statusCode", "quantity")), F.lit("]"))
    keys = sample_keys(rows.select(F.when(F.col("l_linenumber") < 3, one).otherwise(many).alias("body")))
    return conform(to_snake(rows), shared_columns(keys, _LINE_TARGET))


@query
def trade_requests_paged(spark, folder):
    """Requests for the pages after the first: a customer's orders, two to a page."""
    orders = fx.table(spark, folder, "orders").groupBy("o_custkey").count()
    names = fx.table(spark, folder, "customer").select(F.col("c_name").alias("ticker"), "c_custkey")
    asked = request_grid(names, "stock_intraday_transaction")
    bodies = names.join(orders, F.col("c_custkey") == F.col("o_custkey")).select(
        F.concat_ws("/", F.lit("stock_intraday_transaction"), "ticker", F.lit("0")).alias("request_key"),
        F.to_json(F.struct(F.lit(0).alias("page"), F.lit(2).alias("size"),
                           F.col("count").alias("total"))).alias("body"))
    return page_requests(asked, bodies)


@query
def rolling_null_seconds(spark, folder):
    """Rows without a time, on either side of the density at which the computation changes."""
    bars = _timed_bars(spark, folder).withColumn(
        "sec", F.when(F.dayofmonth("time_stamp") != 1, F.col("sec")))
    outputs = {"sum_volume": ("sum", "volume"), "days": ("count", "close")}
    found = None
    for kind, step in (("sparse", DAY_SECONDS), ("dense", 60), ("any", 0)):
        one = rolling(bars, ["ticker"], "sec", outputs, step_seconds=step).select(
            F.lit(kind).alias("kind"), "ticker", "time_stamp", "sum_volume", "days")
        found = one if found is None else found.unionByName(one)
    return found


@query
def statements_end_to_end(spark, folder):
    """From the master list to a table: tickers, requests, recorded bodies (some are missing)."""
    name, recorded = "cash_flow", new_path(spark, "archive")
    fx.bodies(spark, folder, name).filter(~F.col("ticker").endswith("7")).write.options(
        **fx.RECORDED).parquet(recorded)
    tickers = tickers_of_master_list(fx.master_list_bodies(spark, folder), MASTER_LIST)
    wanted = request_grid(tickers, name).drop("path")
    found = wanted.join(recorded_requests(spark, recorded).drop("ticker", "flag"), "request_key", "left")
    landed = fetch(found.withColumn("path", F.coalesce("path", F.lit(""))), replay, order=("file_path", "row_index"))
    db = _new_db(spark)
    good, failed = loads.readable(db, lambda _: landed, name)
    store.overwrite(loads.statements(good, name), db, name)
    loaded = store.read_table(spark, db, name).groupBy("ticker").agg(
        F.count("*").alias("rows"), F.round(F.sum("free_cash_flow"), 2).alias("free_cash_flow"))
    return loaded.unionByName(failed.select("ticker", F.lit(0).cast("bigint").alias("rows"),
                                            F.lit(None).cast("double").alias("free_cash_flow")))


def _recorded(spark: SparkSession, folder: str, names: list[str]) -> DataFrame:
    """What a service would answer for these datasets of all companies, by path."""
    tickers = fx.listing(spark, folder).select("ticker").distinct()     # a body is recorded once, however many share a name
    found = fx.master_list_bodies(spark, folder).agg(F.to_json(F.struct(F.flatten(F.collect_list(
        F.from_json("body", MASTER_LIST)["items"])).alias("items"))).alias("body")).select(
        F.lit(ENDPOINTS[MASTER].path).alias("path"), "body")
    for name in names:
        paths = request_grid(tickers, name).select("request_key", "path")
        found = found.unionByName(fx.bodies(spark, folder, name).join(paths, "request_key").select("path", "body"))
    return found


@query
def companies_end_to_end(spark, folder):
    """From the master list over requests, lookups and bodies to the companies, a rating and a statement."""
    names = ["listing_companies", "valuation_rating", "cash_flow"]
    place = new_path(spark, "fetched")
    transport = archived(fx.archive(_recorded(spark, folder, names), new_path(spark, "archive")))
    tickers = loads.universe(spark, transport, place)
    asked = loads.fetching_inbox(tickers, transport, place, "1992-01-01", "2002-01-01", AS_OF)
    db = _new_db(spark)
    loads.load_companies(spark, db, asked)
    good, _ = loads.readable(db, asked, "valuation_rating")
    store.append_new(loads.ratings(good, "valuation_rating", AS_OF), db, "valuation_rating")
    good, _ = loads.readable(db, asked, "cash_flow")
    store.overwrite(loads.statements(good, "cash_flow"), db, "cash_flow")
    return _table_counts(spark, db, ["companies_info", *names])


@query
def bars_end_to_end(spark, folder):
    """From requests of all brands to bars and indicators, by the daily way."""
    brands = fx.table(spark, folder, "part").select(F.col("p_brand").alias("ticker")).distinct()
    paths = bar_requests(brands, "1992-01-01", "2002-01-01").select("request_key", "path")
    found = fx.whole_bar_bodies(spark, folder).join(paths, "request_key")
    transport = archived(fx.archive(found, new_path(spark, "archive")))
    asked = loads.fetching_inbox(brands, transport, new_path(spark, "fetched"), "1992-01-01", "2002-01-01", AS_OF)
    db = _new_db(spark)
    loads.load_bars(db, asked)
    loads.load_indicators(spark, db, full=False)
    return _table_counts(spark, db, store.SERIES)


@query
def trades_end_to_end(spark, folder):
    """All pages of all trades, whether or not their number is said, from requests to numbered rows."""
    tickers = fx.trades(spark, folder).select("ticker").distinct()
    path = F.replace("path", F.lit("page=0"), F.concat(F.lit("page="), F.col("page").cast("string")))
    pages = trade_requests(tickers, F.lit(AS_OF)).select("ticker", "path").join(
        fx.paged_trades(spark, folder), "ticker").withColumn("path", path)
    transport = archived(fx.archive(pages, new_path(spark, "archive")))
    asked = loads.fetching_inbox(tickers, transport, new_path(spark, "fetched"), "1992-01-01", "2002-01-01", AS_OF)
    db, name = _new_db(spark), "stock_intraday_transaction"
    loads.load_trades(spark, db, asked, AS_OF)
    rows = store.read_table(spark, db, name)
    return rows.groupBy("ticker").agg(
        F.count("*").alias("trades"), F.sum("volume").alias("volume"), F.round(F.sum("price"), 2).alias("price"),
        F.min("id").alias("first_id"), F.max("id").alias("last_id"))


@query
def trade_ids_of_loads(spark, folder):
    """Two sessions, loaded one after the other, and the first of them once more: numbers go on without a gap."""
    db, name = _new_db(spark), "stock_intraday_transaction"
    landed = _inbox(spark, folder)
    for day in (14, 15, 14):
        part = F.col("flag") % 2 == day % 2
        loads.load_trades(spark, db, lambda dataset: landed(dataset).filter(part), date(2024, 2, day))
    rows = store.read_table(spark, db, name)
    return rows.groupBy(F.date_format("time_stamp", "yyyy-MM-dd").alias("day")).agg(
        F.count("*").alias("trades"), F.countDistinct("id").alias("ids"), F.min("id").alias("first_id"),
        F.max("id").alias("last_id"))


@query
def fetch_after_failures(spark, folder):
    """Pages from a service that fails the first time for every seventh: only those are asked for again."""
    marks = new_path(spark, "marks")
    archive = fx.archive(fx.table(spark, folder, "pages").select(
        F.col("page_id").cast("string").alias("path"), F.col("html").alias("body")), f"{marks}/archive")
    requests = fx.table(spark, folder, "pages").select(
        F.col("page_id").cast("string").alias("request_key"), F.col("url").alias("ticker"), F.lit(0).alias("flag"),
        F.col("page_id").cast("string").alias("path"))
    look_up, ledger = archived(archive), f"{marks}/ledger"

    def failing(paths):
        def passed():
            for path in paths:
                if int(path) % 7 == 0:
                    raise ConnectionError(path)
                yield path

        yield from look_up(passed())

    first = fetch_resumed(requests, failing, ledger, attempts=1)
    first.count()
    landed = fetch_resumed(requests, look_up, ledger)
    times = spark.read.parquet(ledger).groupBy("request_key").agg(F.count(F.lit(1)).alias("times"))
    return landed.join(times, "request_key").select(
        F.col("request_key").cast("bigint").alias("page_id"), F.col("body").alias("html"), "times")


@query
def payload_types(spark, folder):
    """Keys of order lines whose sent type does not fit: a text among numbers, a fraction, an unknown key."""
    order = F.col("l_orderkey").alias("orderKey")
    quantity = F.when(F.col("l_returnflag") == "R", F.to_json(F.struct(F.lit("many").alias("quantity"), order))).otherwise(
        F.to_json(F.struct(F.col("l_quantity").alias("quantity"), order, F.col("l_linestatus").alias("status"))))
    rest = F.to_json(F.struct((F.lit(0.5) + F.col("l_linenumber")).alias("lineNumber"), F.col("l_linestatus").alias("remark")))
    body = F.when(F.col("l_linenumber") == 1, F.concat(F.lit("["), quantity, F.lit(","), rest, F.lit("]"))).otherwise(quantity)
    schema = T.StructType([T.StructField("quantity", T.DoubleType()), T.StructField("orderKey", T.LongType()),
                           T.StructField("status", T.StringType()), T.StructField("lineNumber", T.IntegerType())])
    return types_of(fx.table(spark, folder, "lineitem").select(body.alias("body")), schema)


@query
def append_counts(spark, folder):
    """What three loads were sent, left out and added, as counted by the passes that wrote."""
    db, name = _new_db(spark), "stock_history"
    bars = fx.bars(spark, folder).withColumn(
        "time_stamp", F.when(F.dayofmonth("time_stamp") % 7 != 0, F.col("time_stamp")))
    early = bars.filter(F.col("time_stamp").isNull() | (F.col("time_stamp") < "1999-01-01"))
    rows = []
    for i, sent in enumerate([early, early.unionByName(early), bars]):
        done = store.append_new(sent, db, name)
        rows.append((i, done.sent, done.null_keys, done.added, done.repeated))
    return spark.createDataFrame(rows, "load int, sent bigint, null_keys bigint, added bigint, repeated bigint")


@query
def schema_probe(spark, folder):
    """The stored schema of the bars, and how many values each column holds."""
    db, name = _new_db(spark), "stock_history"
    store.append(fx.bars(spark, folder), db, name)
    fields = [(f.name, f.dataType.simpleString()) for f in store.table_schema(spark, db, name)]
    counts = store.read_table(spark, db, name).select(*(F.count(c).alias(c) for c, _ in fields))
    listed = F.explode(F.array(*(F.struct(F.lit(i).alias("place"), F.lit(c).alias("column_name"), F.lit(t).alias("type"),
                                          F.col(c).alias("present")) for i, (c, t) in enumerate(fields))))
    return counts.select(listed.alias("f")).select("f.*")


@query
def empty_relation(spark, folder):
    """Bars added to an empty relation of their declared schema, and what is left of them after a filter of it."""
    schema = TABLES["stock_history"].schema
    none = empty(spark, schema)
    rows = none.unionByName(conform(fx.bars(spark, folder), schema))
    kept = only_new(rows, none, ["ticker", "time_stamp"])
    return rounded(kept.select("ticker", "time_stamp", "close", "volume"))


@query
def initial_load_resumed(spark, folder):
    """A load that dies before the bars is begun again: what was finished is not repeated."""
    db, landed = _new_db(spark), _inbox(spark, folder)
    died = []

    def dying(dataset: str) -> DataFrame:
        if dataset == "stock_history" and not died:
            died.append(dataset)
            raise ConnectionError(dataset)
        return landed(dataset)

    try:
        loads.initial_load(spark, db, dying, AS_OF, run="first")
    except ConnectionError:
        loads.initial_load(spark, db, dying, AS_OF, run="first")
    loads.initial_load(spark, db, dying, AS_OF, run="first")
    counts = _table_counts(spark, db, ["listing_companies", "cash_flow", "valuation_rating", *store.SERIES])
    steps = spark.table(f"{db}.{loads.STEPS}").groupBy(F.concat(F.lit("step "), "step").alias("table_name")).agg(
        F.count(F.lit(1)).alias("rows"), F.lit(None).cast("double").alias("total"))
    return counts.unionByName(steps)


@query
def indicators_of_buckets(spark, folder):
    """Indicators over stored bars that are dealt by ticker: no exchange is left."""
    db = _new_db(spark, buckets=8)
    store.append(fx.bars(spark, folder), db, "stock_history")
    return rounded(ind.indicators(store.read_table(spark, db, "stock_history")), 4, sma=8)


def _stored_indicators(spark: SparkSession, db: str) -> DataFrame:
    return rounded(store.read_table(spark, db, "derived_stock_history"), 4, sma=8)


def _rows_of_refresh(spark, folder, first_year_left_out: str, catch_up: bool) -> DataFrame:
    """Indicators of the early bars, then of what a refresh adds after the late ones came."""
    db = _new_db(spark)
    bars = fx.bars(spark, folder)
    loads.add_bars(db, bars.filter(F.col("time_stamp") < first_year_left_out))
    loads.load_indicators(spark, db, full=True)
    loads.add_bars(db, bars.filter(F.col("time_stamp") >= first_year_left_out))
    loads.load_indicators(spark, db, full=False, catch_up=catch_up)
    return _stored_indicators(spark, db)


@query
def daily_refresh_after_gap(spark, folder):
    """Bars of more than a year came since the last run: catching up derives all of them."""
    return _rows_of_refresh(spark, folder, "2000-06-01", True)


@query
def indicators_latest_stored(spark, folder):
    """Only the newest bar of each ticker is added, from the tails that the run before has kept."""
    return _rows_of_refresh(spark, folder, "2001-01-01", False)


@query
def daily_refresh_30_days(spark, folder):
    """Thirty days, each with its bars and a run, give what one computation over all bars gives."""
    db, bars = _new_db(spark), checkpoint(fx.bars(spark, folder).filter("time_stamp < '1998-08-01'"))
    loads.add_bars(db, bars.filter("time_stamp < '1998-07-01'"))
    loads.load_indicators(spark, db, full=True)
    for day in range(1, 31):
        loads.add_bars(db, bars.filter(F.col("time_stamp").cast("date") == F.lit(date(1998, 7, day))))
        loads.load_indicators(spark, db, full=False)
    return _stored_indicators(spark, db)


@query
def refresh_reconciled(spark, folder):
    """Two days were missed, and one ticker's bar of a month before came late: both are found and derived, and the
    rows that they change are derived anew."""
    db, bars = _new_db(spark), checkpoint(fx.bars(spark, folder).filter("time_stamp < '1998-09-01'"))
    late = (F.col("ticker") == "Brand#11") & (F.month("time_stamp") == 6) & (F.year("time_stamp") == 1998)
    loads.add_bars(db, bars.filter(~late & (F.col("time_stamp") < "1998-08-20")))
    loads.load_indicators(spark, db, full=True)
    loads.add_bars(db, bars.filter(F.col("time_stamp") >= "1998-08-20"))
    loads.load_indicators(spark, db, full=False, catch_up=False)      # derives the newest bars only
    loads.add_bars(db, bars.filter(late))
    loads.load_indicators(spark, db, full=False)                      # finds the late ones and those missed
    loads.reconcile(spark, db)                                        # finds the rest
    return _stored_indicators(spark, db)
