"""Bodies to tables, and the refreshes that chain them.

The first group is lazy: bodies (``request_key, ticker, flag, body``) in, rows of a declared table
out. The second group writes. Dates and times are parameters, so a run can be repeated.

Loads keep a few small tables of their own beside the stored ones. ``bars_pending`` holds the bars that were added
and have no indicators yet, ``bars_tail`` the bars of each ticker that its next indicators look back to, so a
daily run reads neither stored history nor a summary of it. ``finished_steps`` says what a run has done.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import (
    Column, DataFrame, Observation, SparkSession, Window, functions as F, types as T)

from barloom.functions.timefns import (
    epoch_seconds, parse_timestamp, session_timestamp, year_quarter)
from barloom.model import (
    ENDPOINTS, MASTER, MASTER_LIST, PAGE_HEADER, RATINGS, STATEMENTS, TABLES, TRADE_NAMES)
from barloom.operators.conform import conform
from barloom.operators.ordering import ordered_id, ticker_sample
from barloom.operators.payload import (
    PARSED, decode_array, decode_object, decode_wrapped, parse_once, rows_of, tickers_of_master_list, unreadable)
from barloom.operators.quality import (
    drop_null_keys, normalise_ticker, one_per_ticker, only_new)
from barloom.operators.rolling import MONTH_SECONDS
from barloom.plans.indicators import OUTPUT, affected_rows, indicators, recent_bars, tail_of
from barloom.session import broadcast_if_small, observed, plain_numbers, settle
from barloom.sources import store
from barloom.sources.requests import (
    Transport, bar_requests, fetch_pages, fetch_resumed, request_grid, trade_requests)

Inbox = Callable[[str], DataFrame]  # dataset -> landed bodies
HEADERS = {"stock_intraday_transaction": PAGE_HEADER}
#: What the rows of a dataset keep of their body, to choose among rows of one ticker.
KEPT = {"listing_companies": ["request_key"], **{name: ["flag"] for name in RATINGS}}
#: The body of a row that stands for an unreadable one.
UNREAD = "_unread"
#: Rows that one task sorts when trades are numbered.
RANGE_ROWS = 1 << 20
PENDING, TAIL, STEPS = "bars_pending", "bars_tail", "finished_steps"


def parsed(bodies: DataFrame, name: str) -> DataFrame:
    """Bodies of a dataset, each parsed once, to be written aside and read for good and bad ones."""
    endpoint = ENDPOINTS[name]
    return parse_once(bodies, endpoint.kind, endpoint.schema, HEADERS.get(name))


def decoded(bodies: DataFrame, name: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """The rows that the bodies of a dataset hold; :func:`readable` gives such rows already."""
    endpoint, header = ENDPOINTS[name], HEADERS.get(name)
    if "body" not in bodies.columns:
        return bodies.select(*keep, *(c for c in bodies.columns if c not in KEPT.get(name, [])))
    if PARSED in bodies.columns:
        return rows_of(bodies, endpoint.kind, endpoint.schema, header, keep)
    if endpoint.kind == "wrapped":
        return decode_wrapped(bodies, endpoint.schema, header, keep)
    return (decode_array if endpoint.kind == "array" else decode_object)(bodies, endpoint.schema, keep)


def statements(bodies: DataFrame, name: str) -> DataFrame:
    """Rows of one of the four statement tables."""
    table = TABLES[name]
    rows = normalise_ticker(decoded(bodies, name))
    return conform(drop_null_keys(rows, table.key), table.schema)


def ratings(bodies: DataFrame, name: str, as_of: date) -> DataFrame:
    """Rows of one of the six rating tables: one per ticker, for the quarter of ``as_of``."""
    table = TABLES[name]
    rows = decoded(bodies, name, ("flag",))
    year, quarter = year_quarter(F.lit(as_of))
    stamped = one_per_ticker(rows, ["flag"]).withColumns({"year": year, "quarter": quarter})
    return conform(drop_null_keys(stamped, table.key), table.schema)


def daily_bars(bodies: DataFrame) -> DataFrame:
    rows = decoded(bodies, "stock_history")
    stamped = rows.withColumn("time_stamp", parse_timestamp(F.col("trading_date")))
    return conform(normalise_ticker(stamped), TABLES["stock_history"].schema)


def trades(bodies: DataFrame, trading_date: date) -> DataFrame:
    """Trades of one session, without their id."""
    rows = decoded(bodies, "stock_intraday_transaction").withColumnsRenamed(TRADE_NAMES)
    stamped = rows.withColumn("time_stamp", session_timestamp(F.lit(trading_date), F.col("t")))
    table = TABLES["stock_intraday_transaction"].schema
    return conform(normalise_ticker(stamped), T.StructType([f for f in table if f.name != "id"]))


def numbered_trades(rows: DataFrame, start: int = 0, count: int | None = None) -> DataFrame:
    """Ids by ticker and time; the other columns only settle ties. ``count`` rows, if known, say how many ranges
    they are sorted in."""
    first = ["ticker", "time_stamp"]
    return ordered_id(rows, first + [c for c in rows.columns if c not in first], start=start,
                      partitions=count and -(-count // RANGE_ROWS))


def companies(bodies: DataFrame) -> DataFrame:
    """Overview rows, one per ticker, with the columns of both company tables."""
    rows = decoded(bodies, "listing_companies", ("request_key",))
    return one_per_ticker(rows, ["request_key"]).drop("request_key")


def split_companies(overview: DataFrame, listed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Listing rows of tickers not stored yet, and info rows of all."""
    listing = overview.select(*TABLES["listing_companies"].columns)
    info = overview.select(*TABLES["companies_info"].columns)
    return only_new(listing, listed, ["ticker"]), info


def readable(db: str, inbox: Inbox, name: str) -> tuple[DataFrame, DataFrame]:
    """The rows of the bodies that a load can read, and the tickers of the others, which go to the rejects.

    Each body is parsed once, in the pass that writes its rows aside and counts what cannot be read. Neither bodies
    nor what they were parsed into are written: a body that cannot be read stands among the rows as one.
    """
    seen, kept, endpoint = Observation(), KEPT.get(name, []), ENDPOINTS[name]
    unread = F.when(F.col(PARSED).isNull(), F.struct(F.upper("ticker").alias("ticker"), F.col("body").alias("content")))
    bodies = parsed(inbox(name), name).withColumn(UNREAD, unread)
    rows = rows_of(bodies, endpoint.kind, endpoint.schema, HEADERS.get(name), [*kept, UNREAD], outer=True)
    held = settle(rows.observe(seen, F.count(UNREAD).alias("unread")), f"rows-{name}", compression="zstd",
                  **plain_numbers(rows.schema))
    good = held.filter(F.col(UNREAD).isNull()).drop(UNREAD)
    if not observed(seen, unread=0)["unread"]:
        return good, held.sparkSession.createDataFrame([], "ticker string")
    return good, _rejected(held.filter(F.col(UNREAD).isNotNull()).select(f"{UNREAD}.*"), db, name)


def _rejected(bad: DataFrame, db: str, name: str) -> DataFrame:
    """Keep the bodies that cannot be read (``ticker, content``) with the rejects; returns their tickers."""
    store.reject(bad.select(F.lit(name).alias("dataset"), "ticker", F.lit("unreadable body").alias("reason"),
                            "content"), db, name)
    return bad.select("ticker").distinct()


def kept_rows(fresh: DataFrame, failed: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """The stored rows of tickers that failed, where there is no fresh one of their key.

    Rows of other tickers are dropped before anything is joined by key, so neither table is shuffled for a few.
    """
    few = broadcast_if_small(failed)
    kept, again = (rows.join(few, "ticker", "left_semi") for rows in (stored, fresh))
    return only_new(kept, again, keys)


def with_stored(fresh: DataFrame, failed: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Rows to overwrite a table with: fresh ones, and the stored ones of tickers that failed."""
    return fresh if failed.isEmpty() else fresh.unionByName(kept_rows(fresh, failed, stored, keys))


def load_companies(spark: SparkSession, db: str, inbox: Inbox) -> None:
    good, failed = readable(db, inbox, "listing_companies")
    overview = settle(drop_null_keys(companies(good), ["ticker"]), "overview")
    new, info = split_companies(overview, store.read_table(spark, db, "listing_companies"))
    store.append(new, db, "listing_companies")
    stored = store.read_table(spark, db, "companies_info")
    store.overwrite(with_stored(info, failed, stored, ["ticker"]), db, "companies_info")


def _side_by_side(load: Callable[[str], object], names: list[str]) -> list:
    """Independent tables at the same time, so that small ones do not leave the cluster idle."""
    with ThreadPoolExecutor(len(names)) as pool:
        return [done.result() for done in [pool.submit(load, name) for name in names]]


def load_statements(db: str, inbox: Inbox) -> None:
    """Replace the statements; tickers with an unreadable body keep the rows they had.

    The rows of the bodies are the table's, so they are written once, to the folder that takes its place. Only if some
    body cannot be read are the bodies parsed again, for those alone, and kept rows added before the folder is in place.
    """
    def load(name: str) -> None:
        seen, table, endpoint = Observation(), TABLES[name], ENDPOINTS[name]
        bodies = inbox(name)
        spark, kept = bodies.sparkSession, None
        path = store.write_beside(statements(parsed(bodies, name).observe(
            seen, F.count_if(F.col(PARSED).isNull()).alias("unread")), name), db, name)
        if observed(seen, unread=0)["unread"]:
            unread = unreadable(bodies, endpoint.kind, endpoint.schema, HEADERS.get(name)).select(
                F.upper("ticker").alias("ticker"), F.col("body").alias("content"))
            failed = _rejected(settle(unread, f"unread-{name}", compression="zstd"), db, name)
            fresh = spark.read.schema(table.schema).parquet(path)
            kept = kept_rows(fresh, failed, store.read_table(spark, db, name), table.key)
        store.put_in_place(spark, db, name, path, kept)

    _side_by_side(load, STATEMENTS)


def load_ratings(db: str, inbox: Inbox, as_of: date) -> None:
    def load(name: str) -> None:
        good, _ = readable(db, inbox, name)
        # one row per ticker, none without a key, all of one year
        store.append_new(ratings(good, name, as_of), db, name, unique=True, within=(as_of.year, as_of.year), dealt=True)

    _side_by_side(load, RATINGS)


def add_bars(db: str, bars: DataFrame) -> store.Appended:
    """Append bars that are not stored yet and note them as without indicators.

    They are noted first: a run that dies in between notes them again, and a note of a bar that has its
    indicators does no harm.
    """
    spark, name = bars.sparkSession, "stock_history"
    store.side_table(spark, db, PENDING, _columns_of(name))
    return store.append_new(bars, db, name, before=lambda rows: rows.write.insertInto(f"{db}.{PENDING}"))


def load_bars(db: str, inbox: Inbox) -> store.Appended:
    good, _ = readable(db, inbox, "stock_history")
    return add_bars(db, daily_bars(good))


def load_trades(spark: SparkSession, db: str, inbox: Inbox, trading_date: date) -> None:
    """Add the trades that are not stored yet; equal trades of a session count as often as sent."""
    name = "stock_intraday_transaction"
    good, _ = readable(db, inbox, name)
    key = ["ticker", "time_stamp"]
    sent = store.keyed_rows(store.counted_rows(trades(good, trading_date), key), key, db, name)
    stored = store.session_rows(spark, db, name, trading_date)
    fresh = store.settled_rows(sent.exceptAll(stored.select(*sent.columns)), key, name)
    if fresh.sent:
        start = store.take_ids(spark, db, fresh.sent)
        # ranges of one day are written as they lie: a day is one partition, which one task would sort again
        store.append(numbered_trades(fresh.rows, start, fresh.sent), db, name, dealt=True)


def _columns_of(name: str) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TABLES[name].schema)


def load_indicators(spark: SparkSession, db: str, full: bool, catch_up: bool = True) -> None:
    """All indicators of the stored bars, or those of the bars that were added since the last run.

    The second way reads what was added and each ticker's tail, and no stored bar. Without ``catch_up`` only
    the newest bar of each ticker is derived, and :func:`reconcile` finds the others. A bar that came
    later than a newer one of its ticker changes rows that are stored, and is handed to ``reconcile``.
    """
    name, columns = "derived_stock_history", _columns_of("stock_history")
    pending = store.side_table(spark, db, PENDING, columns)
    tail = store.side_table(spark, db, TAIL, columns)
    if full:
        bars = store.read_table(spark, db, "stock_history")
        store.append_new(indicators(bars), db, name, unique=True, near=False)
        store.replace_folder(settle(recent_bars(bars), "tail"), db, TAIL)
        store.replace_folder(pending.limit(0), db, PENDING)
        return
    sec = epoch_seconds(F.col("time_stamp"))
    done = tail.groupBy("ticker").agg(F.max(sec).alias("done"))
    late = F.col("done").isNotNull() & (sec <= F.col("done"))
    seen = Observation()
    fresh = settle(pending.dropDuplicates(["ticker", "time_stamp"]).join(done, "ticker", "left")
                   .withColumn("late", late).observe(
                       seen, F.count(F.lit(1)).alias("n"), F.count_if("late").alias("late"),
                       F.min(store.quarter_of(F.col("time_stamp"))).alias("first"),
                       F.max(store.quarter_of(F.col("time_stamp"))).alias("last")), "fresh")
    counts = observed(seen, n=0, late=0, first=None, last=None)
    if not counts["n"]:
        return
    touched = fresh.select("ticker").distinct()
    known = tail.join(touched, "ticker", "left_semi")
    series = known.unionByName(fresh.select(*tail.columns)).dropDuplicates(["ticker", "time_stamp"])
    wanted = fresh.filter("not late").select("ticker", "time_stamp")
    if not catch_up:
        wanted = wanted.groupBy("ticker").agg(F.max("time_stamp").alias("time_stamp"))
    derived = indicators(series).join(wanted, ["ticker", "time_stamp"], "left_semi")
    store.append_new(derived.select(*OUTPUT), db, name, unique=True, within=(counts["first"], counts["last"]))
    if counts["late"]:
        reconcile(spark, db, fresh.filter("late").select("ticker").distinct())
    store.replace_folder(tail_of(series).unionByName(tail.join(touched, "ticker", "left_anti")), db, TAIL)
    store.replace_folder(pending.limit(0), db, PENDING)


def digests(spark: SparkSession, db: str, name: str, tickers: DataFrame | None = None) -> DataFrame:
    """``(ticker, p_quarter, n, keys)``: how many rows a series has in a quarter, and the XOR of their key hashes.

    Reads keys only, and sums map-side.
    """
    rows = spark.table(f"{db}.{name}")
    if tickers is not None:
        rows = rows.join(tickers, "ticker", "left_semi")
    return rows.groupBy("ticker", store.HIDDEN_QUARTER).agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("ticker", "time_stamp")).alias("keys"))


def differing_quarters(spark: SparkSession, db: str, tickers: DataFrame | None = None) -> DataFrame:
    """``(ticker, p_quarter, differs)``: all quarters with bars, and whether the indicators lack or repeat some."""
    quarter = store.HIDDEN_QUARTER
    bars = digests(spark, db, "stock_history", tickers)
    derived = digests(spark, db, "derived_stock_history", tickers).select(
        "ticker", quarter, F.col("n").alias("m"), F.col("keys").alias("other"))
    same = (F.col("n") == F.col("m")) & (F.col("keys") == F.col("other"))
    return bars.join(derived, ["ticker", quarter], "left").select(
        "ticker", quarter, (~F.coalesce(same, F.lit(False))).alias("differs"))


def reconcile(spark: SparkSession, db: str, tickers: DataFrame | None = None, span: int = MONTH_SECONDS) -> None:
    """Derive the bars that have no indicators, and anew the rows that such bars change.

    Bars and indicators are compared by one digest per ticker and quarter. Rows are read of the quarters that differ
    and of those around them: before, two spans and the nearest earlier bar are looked back to; afterwards, two spans
    and the next bar may change. Stored quarters that hold a changed row are replaced, others get new rows only.
    """
    name, quarter = "derived_stock_history", store.HIDDEN_QUARTER
    around = -(-3 * span // MONTH_SECONDS)
    held = settle(differing_quarters(spark, db, tickers), "quarters")
    if held.filter("differs").isEmpty():
        return

    def number(m: Column) -> Column:
        return F.floor(m / 100) * 12 + m % 100 - 1

    # a quarter with bars is wanted within some months of one that differs, or next to such in order
    at = number(F.col(quarter)).cast("long")
    by_time = Window.partitionBy("ticker").orderBy("at")
    near = by_time.rangeBetween(-around, around)
    marked = held.withColumn("at", at).withColumn(
        "near", F.max(F.col("differs").cast("int")).over(near) == 1)
    beside = F.max(F.col("near").cast("int")).over(by_time.rowsBetween(-2, 2)) == 1
    wanted = broadcast_if_small(marked.withColumn("wanted", beside).filter("wanted").select("ticker", quarter))
    bars = settle(store.rows_of_quarters(spark, db, "stock_history", wanted), "bars")
    stored = store.rows_of_quarters(spark, db, name, wanted).select("ticker", "time_stamp", F.lit(False).alias("missing"))
    flagged = bars.join(stored, ["ticker", "time_stamp"], "left").withColumn(
        "missing", F.coalesce("missing", F.lit(True)))
    changed = settle(affected_rows(flagged.select("ticker", "time_stamp", "missing"), span), "changed")
    derived = indicators(bars, span).join(changed, ["ticker", "time_stamp"]).select(*OUTPUT, "missing")
    fresh = settle(derived, "derived_again")
    stale = fresh.filter("not missing")
    if stale.isEmpty():
        store.append_new(fresh.select(*OUTPUT), db, name, unique=True)
        return
    changed_quarters = broadcast_if_small(fresh.select(store.quarter_of(F.col("time_stamp")).alias(quarter)).distinct())
    others = spark.table(f"{db}.{name}").join(changed_quarters, quarter, "left_semi").select(*OUTPUT).join(
        fresh.select("ticker", "time_stamp"), ["ticker", "time_stamp"], "left_anti")
    store.replace_partitions(others.unionByName(fresh.select(*OUTPUT)), db, name)


Step = tuple[str, list[str], Callable[[], object]]     # name, datasets that it reads, what it does


def inputs_digest(inbox: Inbox, datasets: list[str]) -> str:
    """A text that changes with any body of the datasets; the order of rows does not count."""
    def digest(name: str) -> str:
        hashed = F.xxhash64("request_key", "ticker", "flag", "body")
        found = inbox(name).agg(F.count(F.lit(1)).alias("n"), F.bit_xor(hashed).alias("x"),
                                F.sum(hashed.cast("decimal(20,0)")).alias("s")).head()
        return f"{name}:{found['n']}:{found['x']}:{found['s']}"

    return ",".join(_side_by_side(digest, datasets))


def run_steps(spark: SparkSession, db: str, run: str, steps: list[Step], inbox: Inbox) -> list[str]:
    """Do the steps that ``run`` has not finished with the same inputs; returns those that were done now.

    A step is noted when it is finished, so a run that is begun again goes on with the step it died in, which
    must stand being done twice.
    """
    ledger = "run string, step string, inputs string"
    noted = store.side_table(spark, db, STEPS, ledger).filter(F.col("run") == run)
    finished = {(r["step"], r["inputs"]) for r in noted.collect()}     # a few rows per run
    done = []
    for name, datasets, work in steps:
        inputs = inputs_digest(inbox, datasets)
        if (name, inputs) not in finished:
            work()
            spark.createDataFrame([(run, name, inputs)], ledger).write.insertInto(f"{db}.{STEPS}")
            done.append(name)
    return done


def initial_load(spark: SparkSession, db: str, inbox: Inbox, as_of: date, run: str | None = None) -> list[str]:
    """Companies, ratings, statements, bars and all indicators. With ``run``, a name, the load goes on where one of
    that name has stopped; without, it does every step."""
    steps: list[Step] = [
        ("companies", ["listing_companies"], lambda: load_companies(spark, db, inbox)),
        ("ratings", RATINGS, lambda: load_ratings(db, inbox, as_of)),
        ("statements", STATEMENTS, lambda: load_statements(db, inbox)),
        ("bars", ["stock_history"], lambda: load_bars(db, inbox)),
        ("indicators", ["stock_history"], lambda: load_indicators(spark, db, full=True))]
    if run:
        return run_steps(spark, db, run, steps, inbox)
    for _, _, work in steps:
        work()
    return [name for name, _, _ in steps]


def quarterly_refresh(spark: SparkSession, db: str, inbox: Inbox, as_of: date) -> None:
    load_companies(spark, db, inbox)
    load_statements(db, inbox)
    load_ratings(db, inbox, as_of)


def daily_refresh(spark: SparkSession, db: str, inbox: Inbox, trading_date: date,
                  catch_up: bool = True) -> None:
    load_bars(db, inbox)
    load_indicators(spark, db, full=False, catch_up=catch_up)
    load_trades(spark, db, inbox, trading_date)


def sample_inbox(inbox: Inbox, tickers: DataFrame, n: int = 3) -> Inbox:
    """The bodies of the first ``n`` tickers only."""
    few = F.broadcast(ticker_sample(tickers, n).select("ticker"))
    return lambda dataset: inbox(dataset).join(few, "ticker", "left_semi")


def sample_run(spark: SparkSession, db: str, inbox: Inbox, tickers: DataFrame, as_of: date,
               n: int = 3) -> None:
    """Initial load and daily refresh for a few tickers."""
    few = sample_inbox(inbox, tickers, n)
    initial_load(spark, db, few, as_of)
    daily_refresh(spark, db, few, as_of)


def fetching_inbox(tickers: DataFrame, transport: Transport, folder: str, first: str, last: str,
                   trading_date: date) -> Inbox:
    """An inbox that asks a service: the requests of a dataset for all tickers, fetched when it is first read.

    Bodies land in a folder per dataset below ``folder``, which is also the ledger: an inbox made anew on it asks
    only for what has not been answered. Trades are asked for page by page.
    """
    landed: dict[str, DataFrame] = {}

    def fetched(name: str) -> DataFrame:
        place = f"{folder.rstrip('/')}/{name}"
        if name == "stock_intraday_transaction":
            asked = trade_requests(tickers, F.lit(trading_date))
            return fetch_pages(asked, transport, lambda more, part: fetch_resumed(more, transport, f"{place}/{part}"))
        asked = bar_requests(tickers, first, last) if name == "stock_history" else request_grid(tickers, name)
        return fetch_resumed(asked, transport, place)

    def inbox(name: str) -> DataFrame:
        if name not in landed:
            landed[name] = fetched(name)
        return landed[name]

    return inbox


def universe(spark: SparkSession, transport: Transport, folder: str) -> DataFrame:
    """The tickers of the master list, asked for by one request."""
    asked = request_grid(spark.createDataFrame([("",)], "ticker string"), MASTER)
    bodies = fetch_resumed(asked, transport, f"{folder.rstrip('/')}/{MASTER}", partitions=1)
    return settle(tickers_of_master_list(bodies, MASTER_LIST), "universe")
