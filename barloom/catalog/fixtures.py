"""Market-data views over the given tables: bars, statements, listing, trades and JSON bodies.

Every body is bounded: its rows are summed per calendar unit first, or taken from one source row,
so no payload gathers an unbounded group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from barloom.model import RATINGS, STATEMENTS, TABLES, service_name


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table; its zoneless timestamps are read as UTC."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    zoneless = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in zoneless})


def _line_order() -> Column:
    """Order of the lines of a day, by amount and quantity; equal numbers have equal prices.

    One bigint fits the fixed-width aggregation buffer, so first and last need no sort.
    """
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    return cents * 100 + F.col("l_quantity").cast("bigint")


def bars(spark: SparkSession, folder: str) -> DataFrame:
    """Daily bars per brand, summed map-side before the exchange."""
    lines = table(spark, folder, "lineitem").select(
        "l_partkey", F.col("l_shipdate").alias("time_stamp"), "l_quantity",
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        _line_order().alias("place"),
    )
    brands = table(spark, folder, "part").select("p_partkey", F.col("p_brand").alias("ticker"))
    return (
        lines.join(brands, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("ticker", "time_stamp")
        .agg(
            F.min_by("price", "place").alias("open"), F.max("price").alias("high"),
            F.min("price").alias("low"), F.max_by("price", "place").alias("close"),
            F.sum("l_quantity").cast("bigint").alias("volume"),
        )
    )


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """Companies, from customers and their nations."""
    nations = table(spark, folder, "nation")
    return (
        table(spark, folder, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_name").alias("ticker"), F.col("n_name").alias("exchange"),
            F.col("c_mktsegment").alias("industry"), "c_custkey", "c_nationkey", "c_acctbal",
        )
    )


def quarters(spark: SparkSession, folder: str) -> DataFrame:
    """Order sums per customer, year and quarter; quarters of three orders lack their number."""
    names = table(spark, folder, "customer").select("c_custkey", F.col("c_name").alias("ticker"))
    sums = table(spark, folder, "orders").groupBy(
        "o_custkey", F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("part")
    ).agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return sums.join(names, F.col("o_custkey") == F.col("c_custkey")).select(
        "ticker", "year", F.when(F.col("orders") != 3, F.col("part")).alias("quarter"),
        "orders", "total",
    )


def trades(spark: SparkSession, folder: str) -> DataFrame:
    """Events as trades: a kind of event is a ticker."""
    return table(spark, folder, "events").select(
        F.col("event_type").alias("ticker"), "event_id", "user_id", "ts",
        F.col("value").alias("price"), F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )


def second_bars(spark: SparkSession, folder: str) -> DataFrame:
    """Bars of one second per kind of event, summed map-side."""
    return trades(spark, folder).groupBy(
        "ticker", F.date_trunc("second", "ts").alias("time_stamp")
    ).agg(F.max("price").alias("high"), F.min("price").alias("low"),
          F.max_by("price", "event_id").alias("close"), F.sum("k").alias("volume"))


# JSON bodies ------------------------------------------------------------------------------------

def _body(dataset: str, ticker: Column, flag: Column | int, body: Column) -> list[Column]:
    flag = F.lit(flag) if isinstance(flag, int) else flag
    return [F.concat_ws("/", F.lit(dataset), ticker, flag).alias("request_key"),
            ticker.alias("ticker"), flag.cast("int").alias("flag"), body.alias("body")]


def value_columns(dataset: str) -> list[T.StructField]:
    """The value columns of a table, all of which a body fills."""
    return [f for f in TABLES[dataset].schema if f.name not in ("ticker", "year", "quarter")
            and not isinstance(f.dataType, T.StringType)]


def _values(dataset: str, whole: Column, amount: Column) -> list[Column]:
    """Payload fields: the whole number for integers, the amount plus its place for doubles."""
    return [(whole + i if isinstance(f.dataType, T.LongType) else amount + i)
            .alias(service_name(f.name)) for i, f in enumerate(value_columns(dataset))]


def statement_lists(spark: SparkSession, folder: str) -> DataFrame:
    """``(ticker, flag, slim)``: what the bodies of all four statements are made of, four numbers an element.

    Flag 0 has the quarters, flag 1 the years (as quarter 5) of a customer.
    """
    per_quarter = quarters(spark, folder)
    per_year = per_quarter.groupBy("ticker", "year").agg(
        F.sum("orders").alias("orders"), F.round(F.sum("total"), 2).alias("total"),
        F.lit(5).alias("quarter"))
    rows = per_quarter.withColumn("flag", F.lit(0)).unionByName(
        per_year.withColumn("flag", F.lit(1)))
    # four numbers of an element are shuffled; its many values are made of them afterwards
    slim = F.collect_list(F.struct("quarter", "year", "orders", "total")).alias("slim")
    return rows.groupBy("ticker", "flag").agg(slim)


def statement_bodies(spark: SparkSession, folder: str, dataset: str, lists: DataFrame | None = None) -> DataFrame:
    """Array bodies of a customer's quarters and years, from ``lists`` if they are at hand.

    A body has at most one element per quarter of the calendar and per row without one.
    """
    lists = statement_lists(spark, folder) if lists is None else lists
    element = F.transform("slim", lambda e: F.struct(
        F.lower("ticker").alias("ticker"), e["quarter"].alias("quarter"), e["year"].alias("year"),
        *_values(dataset, e["orders"], e["total"])))
    return lists.select(*_body(dataset, F.col("ticker"), F.col("flag"), F.to_json(element)))


def rating_bodies(spark: SparkSession, folder: str, dataset: str) -> DataFrame:
    """Object bodies, asked for twice per customer."""
    texts = [F.col("c_mktsegment").alias("industryEn")] \
        if TABLES[dataset].widths.get("industry_en") else []
    element = F.struct(F.lower("c_name").alias("ticker"), *texts,
                       *_values(dataset, F.col("c_custkey"), F.col("c_acctbal")))
    return table(spark, folder, "customer").select(
        "*", F.explode(F.array(F.lit(0), F.lit(1))).alias("flag")
    ).select(*_body(dataset, F.col("c_name"), F.col("flag"), F.to_json(element)))


def overview_bodies(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    element = F.struct(
        F.col("exchange"), F.col("ticker").alias("shortName"),
        F.col("c_nationkey").cast("double").alias("industryID"),
        (F.col("c_nationkey") + 100).alias("industryIDv2"), "industry",
        F.lower("industry").alias("industryEn"),
        (F.lit(1950) + F.pmod(key, F.lit(70))).alias("establishedYear"),
        key.cast("int").alias("noEmployees"), F.lit("CT").alias("companyType"),
        (F.col("c_acctbal") / 4).alias("stockRating"), F.col("c_acctbal").alias("issueShare"),
        F.lower("ticker").alias("ticker"),
    )
    return listing(spark, folder).select(
        *_body("listing_companies", F.col("ticker"), 0, F.to_json(element)))


def bar_bodies(spark: SparkSession, folder: str) -> DataFrame:
    """Wrapped bodies per ticker and year: at most 366 bars each."""
    stamp = F.date_format("time_stamp", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    element = F.struct("open", "high", "low", "close", "volume", stamp.alias("tradingDate"))
    year = F.year("time_stamp").alias("flag")
    grouped = bars(spark, folder).groupBy("ticker", year).agg(F.collect_list(element).alias("data"))
    whole = F.to_json(F.struct(F.lower("ticker").alias("ticker"), "data"))
    return grouped.select(*_body("stock_history", F.col("ticker"), F.col("flag"), whole))


PAGE_ROWS = 500


def trade_bodies(spark: SparkSession, folder: str) -> DataFrame:
    """Wrapped pages of all trades: the event number is unique, so a page has at most 500."""
    element = F.struct(
        F.col("price").alias("p"), F.col("k").alias("v"), F.col("user_id").alias("cp"),
        F.lit(0.0).alias("rcp"), F.lit("BU").alias("a"), (F.col("k") > 50).alias("hl"),
        F.date_format("ts", "HH:mm:ss").alias("t"))
    page = F.floor(F.col("event_id") / PAGE_ROWS).cast("int").alias("page")
    grouped = trades(spark, folder).groupBy("ticker", page).agg(
        F.collect_list(element).alias("data"))
    whole = F.to_json(F.struct("page", F.lit(PAGE_ROWS).alias("size"), F.lit(-1).alias("headIndex"),
                               "ticker", "data"))
    return grouped.select(*_body("stock_intraday_transaction", F.col("ticker"), F.col("page"),
                                 whole))


def whole_bar_bodies(spark: SparkSession, folder: str) -> DataFrame:
    """One wrapped body per ticker with the bars of all years: at most one a day."""
    stamp = F.date_format("time_stamp", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    element = F.struct("open", "high", "low", "close", "volume", stamp.alias("tradingDate"))
    grouped = bars(spark, folder).groupBy("ticker").agg(F.collect_list(element).alias("data"))
    whole = F.to_json(F.struct("ticker", "data"))
    return grouped.select(*_body("stock_history", F.col("ticker"), 0, whole))


def paged_trades(spark: SparkSession, folder: str) -> DataFrame:
    """``(ticker, page, body)``: trades by pages. Clicks and errors say how many there are in all; the pages of
    other tickers have no total, only a size that each fills."""
    element = F.struct(
        F.col("price").alias("p"), F.col("k").alias("v"), F.lit("BU").alias("a"), (F.col("k") > 50).alias("hl"),
        F.date_format("ts", "HH:mm:ss").alias("t"))
    page = F.floor(F.col("event_id") / PAGE_ROWS).cast("int").alias("page")
    grouped = trades(spark, folder).groupBy("ticker", page).agg(F.collect_list(element).alias("data"))
    last = grouped.groupBy("ticker").agg(F.max("page").alias("last"))
    total = F.when(F.col("ticker").isin("click", "error"), (F.col("last") + 1) * PAGE_ROWS)
    size = F.when(total.isNull(), F.size("data")).otherwise(F.lit(PAGE_ROWS))
    body = F.to_json(F.struct("page", size.alias("size"), total.alias("total"), "ticker", "data"))
    return grouped.join(F.broadcast(last), "ticker").select("ticker", "page", body.alias("body"))


#: Recorded bodies are kept in small row groups, so that a task reads little more than its own.
RECORDED = {"parquet.block.size": str(8 << 20), "parquet.block.size.row.check.min": "10"}


def archive(found: DataFrame, place: str) -> str:
    """Write recorded ``path, body`` rows for the transport that looks them up."""
    found.select("path", "body").repartitionByRange("path").sortWithinPartitions("path").write.options(
        **RECORDED).parquet(place)
    return place


def master_list_bodies(spark: SparkSession, folder: str) -> DataFrame:
    """Pages of the ticker master list, at most 500 items each."""
    page = F.floor(F.col("c_custkey") / PAGE_ROWS)
    items = F.collect_list(F.struct(F.col("c_name").alias("ticker"),
                                    F.col("c_custkey").alias("organCode")))
    return table(spark, folder, "customer").groupBy(page.alias("page")).agg(
        F.to_json(F.struct(items.alias("items"))).alias("body")).select("body")


def bodies(spark: SparkSession, folder: str, dataset: str) -> DataFrame:
    """The bodies of any dataset."""
    if dataset in STATEMENTS:
        return statement_bodies(spark, folder, dataset)
    if dataset in RATINGS:
        return rating_bodies(spark, folder, dataset)
    return {"listing_companies": overview_bodies, "stock_history": bar_bodies,
            "stock_intraday_transaction": trade_bodies}[dataset](spark, folder)
