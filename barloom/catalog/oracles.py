"""The queries as SQL for DuckDB over the same tables."""

from __future__ import annotations

from barloom.catalog.fixtures import value_columns
from barloom.catalog.oracle_views import BARS, INDICATORS, SECONDS, with_views
from barloom.model import RATINGS, STATEMENTS, TABLES
from pyspark.sql import types as T

_MONTH = "(partition by ticker order by sec range between 2629800 preceding and current row)"
_DAY = "(partition by event_type order by sec range between 86400 preceding and current row)"

SECOND_BARS = """bars as (
  select event_type as ticker, date_trunc('second', ts) as time_stamp, max(value) as high,
         min(value) as low, arg_max(value, event_id) as close,
         cast(sum(cast(json_extract_string(props, '$.k') as bigint)) as bigint) as volume
  from events group by 1, 2)"""

QUARTERS = """sums as (
  select o_custkey, year(o_orderdate) as year, quarter(o_orderdate) as part, count(*) as orders,
         round(sum(o_totalprice), 2) as total
  from orders group by 1, 2, 3),
quarters as (
  select c_name as ticker, year, case when orders <> 3 then part end as quarter, orders, total
  from sums join customer on o_custkey = c_custkey)"""

# flag 1 repeats the sums per year, as quarter 5
STATEMENT_ROWS = QUARTERS + """,
stated as (
  select ticker, year, quarter, orders, total from quarters
  union all
  select ticker, year, 5, cast(sum(orders) as bigint), round(sum(total), 2)
  from quarters group by 1, 2),
statement as (
  select upper(ticker) as ticker, year, quarter, orders, total from stated
  where ticker is not null and year is not null and quarter is not null)"""

_INDICATOR_ROWS = """select ticker, time_stamp, round(sma, 8) as sma,
  round(lower_bollinger, 4) as lower_bollinger, round(higher_bollinger, 4) as higher_bollinger,
  round(money_flow, 4) as money_flow from derived"""

_K = "cast(json_extract_string(props, '$.k') as bigint)"
_LATEST = " qualify row_number() over (partition by ticker order by time_stamp desc) = 1"


def _indicators(query: str, bars: str = BARS) -> str:
    return with_views(bars, SECONDS, INDICATORS, query=query)


def _bars(query: str) -> str:
    return with_views(BARS, SECONDS, query=query)


ORACLES: dict[str, str] = {
    "indicators_full": _indicators(_INDICATOR_ROWS),
    "indicators_latest": _indicators(_INDICATOR_ROWS + _LATEST),
    "indicators_dense": _indicators(_INDICATOR_ROWS, SECOND_BARS),
    "bollinger_bands": _indicators("""select ticker, time_stamp, round(sma, 8) as sma,
        round(distance, 4) as distance, round(deviation, 4) as deviation,
        round(lower_bollinger, 4) as lower_bollinger,
        round(higher_bollinger, 4) as higher_bollinger from derived"""),
    "money_flow": _indicators("""select ticker, time_stamp,
        round(typical_price, 8) as typical_price, round(lag_typical_price, 8) as lag_typical_price,
        round(positive, 8) as positive, round(negative, 8) as negative, round(ratio, 4) as ratio,
        round(money_flow, 4) as money_flow from derived"""),
    "rolling_month_avg": _bars(f"""select ticker, time_stamp,
        round(avg(volume) over {_MONTH}, 8) as avg_volume from timed"""),
    "rolling_month_sum": _bars(f"""select ticker, time_stamp,
        cast(sum(volume) over {_MONTH} as bigint) as sum_volume,
        count(close) over {_MONTH} as days from timed"""),
    "rolling_month_ratio": _bars(f"""select ticker, time_stamp,
        round(sum(high) over {_MONTH} / nullif(sum(low) over {_MONTH}, 0), 8) as ratio
        from timed"""),
    "rolling_day_trades": f"""with timed as (
        select *, cast(floor(epoch(ts)) as bigint) as sec, {_K} as k from events)
        select event_id, event_type as ticker, round(sum(value) over {_DAY}, 4) as sum_price,
               round(avg(k) over {_DAY}, 8) as avg_k, count(value) over {_DAY} as trades
        from timed""",
    "lag_by_key_bars": _bars("""select ticker, time_stamp, round(typical_price, 8) as typical_price,
        round(lag(typical_price) over (partition by ticker order by time_stamp), 8)
        as lag_typical_price from timed"""),
    "lag_by_key_trades": """select event_type as ticker, event_id, ts, value as price,
        lag(value) over w as last_price, lag(event_id) over w as last_event from events
        window w as (partition by event_type order by ts, event_id)""",
    "latest_trade": """select user_id, event_id, ts, event_type as ticker, value as price
        from events qualify row_number() over (
          partition by user_id order by ts desc, event_id desc) = 1""",
    "ordered_trade_id": """select event_id, ts,
        row_number() over (order by ts, event_id) - 1 as id from events""",
    "listing_sample": """select c_name as ticker, n_name as exchange, c_mktsegment as industry
        from customer join nation on c_nationkey = n_nationkey order by c_name limit 3""",
    "trailing_days": _bars("""select ticker, time_stamp, round(close, 8) as close, volume
        from bars where time_stamp >= timestamp '2001-11-04' - interval 30 day"""),
    "weekend_rows": "select event_id, ts from events where isodow(ts) > 5",
    "session_times": """select event_id, case when event_type = 'signup'
        then timestamp '2024-02-15' else timestamp '2024-02-15'
          + (date_trunc('second', ts) - date_trunc('day', ts)) end as time_stamp from events""",
    "cleaned_times": """select event_id,
        case when event_type = 'error' then 'x' else '' end
          || strftime(ts, '%Y-%m-%d %H:%M:%S') as text,
        case when event_type <> 'error' then date_trunc('second', ts) end as time_stamp
        from events""",
    "epoch_bounds": _bars("""select ticker, time_stamp, sec,
        cast(epoch(date_trunc('day', time_stamp)) as bigint) as day_start,
        cast(epoch(date_trunc('day', time_stamp)) as bigint) - 32400 as tokyo_start
        from timed"""),
    "statements_clean": with_views(QUARTERS, query="""select upper(ticker) as ticker, year, quarter,
        orders, round(total, 2) as total from quarters
        where ticker is not null and year is not null and quarter is not null"""),
    "rating_snapshot": """select upper(event_type) || '-' || user_id as ticker, event_id,
        value as price, 2024 as year, 1 as quarter from events
        qualify row_number() over (partition by event_type, user_id order by ts, event_id) = 1""",
    "new_listings": """select c_name as ticker, n_name as exchange, c_mktsegment as industry
        from customer c join nation on c_nationkey = n_nationkey
        where not exists (select 1 from customer e
          where e.c_name = c.c_name and e.c_mktsegment <> 'BUILDING')""",
    "pk_violation_rows": """select l_orderkey, l_linenumber, count(*) as rows from lineitem
        group by 1, 2 having count(*) > 1 or l_orderkey is null or l_linenumber is null""",
    "fk_orphan_rows": """select o_orderkey, o_custkey as c_custkey, o_totalprice from orders
        where o_custkey is not null and not exists (select 1 from customer
          where c_custkey = o_custkey and c_mktsegment <> 'MACHINERY')""",
    "text_violation_rows": """with named as (
          select c_custkey, c_name, nullif(c_mktsegment, 'FURNITURE') as segment from customer)
        select *, 'c_name' as "column", 'too long' as problem from named where length(c_name) > 256
        union all select *, 'segment', 'too long' from named where length(segment) > 9
        union all select *, 'c_name', 'null' from named where c_name is null
        union all select *, 'segment', 'null' from named where segment is null""",
    "cascade_delete_rows": """select o_orderkey, o_custkey as c_custkey from orders
        where not exists (select 1 from customer where c_custkey = o_custkey and c_acctbal < 0)""",
    "surviving_rows": """select o_orderkey, o_custkey as c_custkey from orders
        where o_custkey is null or exists (
          select 1 from customer where c_custkey = o_custkey and c_acctbal >= 0)""",
    "flatten_nested": "select o_orderkey, o_custkey, o_totalprice, o_orderstatus from orders",
    "flatten_with_paths":
        "select o_orderkey as order_key, o_custkey as customer_key from orders",
    "snake_names": """select o_orderkey as order_key, o_totalprice as total_price_us_d,
        o_custkey as avg_ro_e, o_orderstatus as last5years_eb_it_da_growth from orders""",
    "conform_schema": """select l_returnflag as flag, cast(l_orderkey as varchar) as order_key,
        cast(trunc(l_quantity) as bigint) as quantity, cast(null as integer) as status_code
        from lineitem""",
    "conform_filled": """select l_returnflag as flag, cast(l_orderkey as varchar) as order_key,
        cast(null as double) as not_sent from lineitem""",
    "requests": """select 'balance_sheet/' || c_name || '/' || flag as request_key,
        c_name as ticker, cast(flag as integer) as flag,
        'finance/' || c_name || '/balancesheet?yearly=' || flag || '&isAll=True' as path
        from customer, (select unnest([0, 1]) as flag)""",
    "requests_between": """select 'stock_history/' || c_name || '/0' as request_key,
        c_name as ticker, 0 as flag, 'bars-long-term?ticker=' || c_name
          || '&type=stock&resolution=D&from=946684800&to=978307200' as path from customer""",
    "requests_of_session": """select c_name as ticker, 'intraday/' || c_name
        || '/his/paging?page=0&size=100000'
        || case when isodow(max(o_orderdate)) > 5 then '&headIndex=-1' else '' end as path
        from orders join customer on o_custkey = c_custkey group by c_name""",
    "json_object": f"""select event_id, {_K} as k, cast(null as varchar) as absent from events""",
    "json_array_rows": """select l_orderkey, l_partkey, cast(i as integer) as row_no,
        round(trunc(l_quantity) * i, 4) as book_value,
        round(l_extendedprice * i, 4) as book_value_change
        from (select *, unnest(range(1, l_linenumber)) as i from lineitem)""",
    "json_array_rows_outer": """select l_orderkey, l_partkey, cast(i as integer) as row_no,
        round(trunc(l_quantity) * i, 4) as book_value,
        round(l_extendedprice * i, 4) as book_value_change
        from (select *, unnest(range(1, l_linenumber)) as i from lineitem)
        union all select l_orderkey, l_partkey, null, null, null from lineitem
        where l_linenumber = 1""",
    "json_wrapped_rows": _bars("""select upper(ticker) as ticker, time_stamp, round(open, 8) as open,
        round(high, 8) as high, round(low, 8) as low, round(close, 8) as close, volume
        from bars"""),
    "json_quarantine": f"""select event_id,
        case when {_K} between 10 and 98 then 'good' else 'bad' end as state from events""",
    "master_tickers": "select distinct c_name as ticker from customer",
    "rating_rows": """select upper(c_name) as ticker, 2024 as year, 1 as quarter,
        c_mktsegment as industry_en, round(c_acctbal, 8) as valuation,
        round(c_acctbal + 1, 8) as pe, round(c_acctbal + 2, 8) as pb,
        round(c_acctbal + 3, 8) as ps, round(c_acctbal + 4, 8) as evebitda,
        round(c_acctbal + 5, 8) as dividend_rate from customer""",
    "trade_rows": f"""with stamped as (
          select value as price, {_K} as volume, cast(user_id as double) as cp, 0.0::double as rcp,
                 'BU' as a, {_K} > 50 as hl, timestamp '2024-02-15'
                   + (date_trunc('second', ts) - date_trunc('day', ts)) as time_stamp,
                 upper(event_type) as ticker from events)
        select row_number() over (order by ticker, time_stamp, price, volume, cp) - 1 as id,
               round(price, 8) as price, volume, cp, rcp, a, hl, time_stamp, ticker
        from stamped""",
    "company_split": """select 'listing' as kind, upper(c_name) as ticker, c_name as name,
          cast(1950 + c_custkey % 70 as double) as number
        from customer where c_mktsegment <> 'BUILDING'
        union all select 'info', upper(c_name), null, c_acctbal from customer""",
    "fetch_landing": "select page_id, url, html from pages",
    "store_roundtrip": """select s_name as ticker, s_acctbal as issue_share,
        s_nationkey as no_employees from supplier""",
    "idempotent_append": _bars(
        "select ticker, time_stamp, round(close, 8) as close, volume from bars"),
    "trailing_store": _bars("""select ticker, time_stamp, round(close, 8) as close, volume
        from bars where time_stamp >= timestamp '2001-11-04' - interval 30 day"""),
    "rewrite_after_delete": _bars("""select ticker, count(*) as days,
        cast(sum(volume) as bigint) as volume from bars
        where ticker not in (select p_brand from part group by 1 having avg(p_size) > 25) group by 1"""),
    "table_lifecycle": _bars("""select 'stock_history' as table_name, count(*) as rows,
        round(cast(sum(volume) as double), 2) as total from bars
        union all select 'listing_companies', 0, null"""),
}


def _counts(table: str, source: str, total: str, rows: str = "count(*)") -> str:
    return (f"select '{table}' as table_name, {rows} as rows, "
            f"round(cast({total} as double), 2) as total from {source}")


def _company_counts(source: str) -> list[str]:
    return [_counts("listing_companies", source, "sum(1950 + c_custkey % 70)"),
            _counts("companies_info", source, "sum(c_acctbal)")]


def _statement_counts(source: str) -> list[str]:
    value = {name: "orders" if isinstance(TABLES[name].schema[3].dataType, T.LongType) else "total"
             for name in STATEMENTS}
    return [_counts(name, source, f"sum({value[name]})") for name in STATEMENTS]


def _rating_counts(source: str, times: int = 1) -> list[str]:
    return [_counts(name, source, f"{times} * sum(c_acctbal)", f"{times} * count(*)")
            for name in RATINGS]


def _bar_counts(history: str, derived: str) -> list[str]:
    return [_counts("stock_history", history, "sum(volume)"),
            _counts("derived_stock_history", derived, "sum(sma)")]


def _all(*views: str, counts: list[str]) -> str:
    return with_views(*views, query="\nunion all ".join(counts))


_LATEST_VIEW = f"latest as (select * from derived{_LATEST})"
_FEW = """few as (select * from customer order by c_name limit 3),
few_statement as (select * from statement where ticker in (select upper(c_name) from few)),
few_brands as (select distinct p_brand from part order by p_brand limit 3),
few_derived as (select * from derived where ticker in (from few_brands)),
few_events as (select * from events where event_type in ('click', 'error'))"""

ORACLES |= {
    "initial_load": _all(
        STATEMENT_ROWS, BARS, SECONDS, INDICATORS,
        counts=[*_company_counts("customer"), *_statement_counts("statement"),
                *_rating_counts("customer"), *_bar_counts("bars", "derived")]),
    "quarterly_refresh": _all(
        STATEMENT_ROWS,
        counts=[*_company_counts("customer"), *_statement_counts("statement"),
                *_rating_counts("customer", 2)]),
    "daily_refresh": _all(
        BARS, SECONDS, INDICATORS, _LATEST_VIEW,
        counts=[*_bar_counts("bars", "latest"),
                _counts("stock_intraday_transaction", "events", f"sum({_K})")]),
    "sample_run": _all(
        STATEMENT_ROWS, BARS, SECONDS, INDICATORS, _FEW,
        counts=[*_company_counts("few"), *_statement_counts("few_statement"),
                *_rating_counts("few"), *_bar_counts("few_derived", "few_derived"),
                _counts("stock_intraday_transaction", "few_events", f"sum({_K})")]),
}

_NULL_MONTH = """(partition by ticker, kept order by sec range between 2629800 preceding
    and current row)"""
_NULL_ROWS = "select ticker, time_stamp, volume, close, sec, day(time_stamp) <> 1 as kept from timed"

ORACLES |= {
    "append_null_keys_twice": _bars("""select ticker,
        count(*) filter (day(time_stamp) % 7 <> 0) as bars,
        count(*) filter (day(time_stamp) % 7 = 0) as aside from bars group by 1
        having bars > 0 and aside > 0"""),
    "statements_with_failed_bodies": _all(STATEMENT_ROWS, counts=_statement_counts("statement")),
    "companies_with_failed_bodies": "\nunion all ".join(_company_counts("customer")),
    "rejects_of_load": """select dataset, upper(c_name) as ticker, 'unreadable body' as reason,
        '<html>502</html>' as content from customer, (select unnest(%r) as dataset)
        where c_name like '%%7'""" % (["listing_companies", *RATINGS],),
    "shared_keys_all_bodies": """select case when l_linenumber > 1 then l_returnflag end as flag,
        cast(l_orderkey as varchar) as order_key,
        case when l_linenumber > 2 then cast(trunc(l_quantity) as bigint) end as quantity,
        cast(null as integer) as status_code from lineitem""",
    "trade_requests_paged": """select 'stock_intraday_transaction/' || c_name || '/0/page' || page
          as request_key, c_name as ticker, 0 as flag,
        'intraday/' || c_name || '/his/paging?page=' || page || '&size=100000' as path
        from (select o_custkey, unnest(range(1, cast(ceil(count(*) / 2) as bigint))) as page
              from orders group by 1) join customer on o_custkey = c_custkey""",
    "rolling_null_seconds": _bars(f"""select kind, ticker, time_stamp,
        cast(case when kept then sum(volume) over {_NULL_MONTH}
             else sum(volume) over (partition by ticker, kept) end as bigint) as sum_volume,
        case when kept then count(close) over {_NULL_MONTH}
             else count(close) over (partition by ticker, kept) end as days
        from ({_NULL_ROWS}), (select unnest(['sparse', 'dense', 'any']) as kind)""".replace(
            "partition by ticker, kept", "partition by kind, ticker, kept")),
}


def _value_list(name: str, whole: str, amount: str, taken: tuple[str, ...] | None = None) -> str:
    """The value columns of a table as the bodies fill them: each has its place added."""
    listed = []
    for i, f in enumerate(value_columns(name)):
        if taken is None or f.name in taken:
            value = f"cast({whole} + {i} as bigint)" if isinstance(f.dataType, T.LongType) else \
                f"cast(round({amount} + {i}, 2) as double)"
            listed.append(f"{value} as {f.name}")
    return ", ".join(listed)


_RATIOS = ("price_to_earning", "price_to_book", "ebitda_on_stock_change", "book_value_per_share_change",
           "credit_growth", "roe")
ORACLES |= {
    "statement_rows": with_views(STATEMENT_ROWS, query="select ticker, year, quarter, " + _value_list(
        "financial_ratio", "orders", "total", _RATIOS) + " from statement"),
    "statements_end_to_end": with_views(STATEMENT_ROWS, query=f"""
        select ticker, count(*) as rows, round(sum(free_cash_flow), 2) as free_cash_flow
        from (select ticker, {_value_list("cash_flow", "orders", "total")} from statement)
        where ticker not like '%7' group by 1
        union all select upper(c_name), 0, null from customer
        where c_name like '%7' or upper(c_name) not in (select ticker from statement)"""),
}
for _name in STATEMENTS:
    ORACLES[f"table_{_name}"] = with_views(STATEMENT_ROWS, query=(
        f"select ticker, year, quarter, {_value_list(_name, 'orders', 'total')} from statement"))
for _name in RATINGS:
    _texts = "c_mktsegment as industry_en, " if TABLES[_name].widths.get("industry_en") else ""
    ORACLES[f"table_{_name}"] = (
        f"select upper(c_name) as ticker, 2024 as year, 1 as quarter, {_texts}"
        f"{_value_list(_name, 'c_custkey', 'c_acctbal')} from customer")
ORACLES |= {
    "daily_refresh_after_gap": _indicators(_INDICATOR_ROWS),
    "indicators_latest_stored": _indicators(_INDICATOR_ROWS + """
        where time_stamp < timestamp '2001-01-01' or time_stamp = (
          select max(time_stamp) from bars where bars.ticker = derived.ticker)"""),
}

_MANY = "select '%s' as key, '%s' as sent, %s as declared, count(*) as \"values\" from lineitem%s"
_EARLY = "day(time_stamp) % 7 = 0 or time_stamp < timestamp '1999-01-01'"
_TRADES = """select event_type as ticker, row_number() over (order by upper(event_type),
    date_trunc('second', ts) - date_trunc('day', ts)) - 1 as id, value, %s as k from events""" % _K

ORACLES |= {
    "companies_end_to_end": with_views(STATEMENT_ROWS, query="\nunion all ".join([
        *_company_counts("customer"), _counts("valuation_rating", "customer", "sum(c_acctbal)"),
        next(c for c in _statement_counts("statement") if "'cash_flow'" in c)])),
    "bars_end_to_end": _all(BARS, SECONDS, INDICATORS, counts=_bar_counts("bars", "derived")),
    "trades_end_to_end": f"""select upper(ticker) as ticker, count(*) as trades, cast(sum(k) as bigint) as volume,
        round(sum(value), 2) as price, min(id) as first_id, max(id) as last_id from ({_TRADES}) group by 1""",
    "trade_ids_of_loads": """select strftime(day, '%Y-%m-%d') as day, trades, trades as ids, before as first_id, before + trades - 1 as last_id
        from (select *, cast(coalesce(sum(trades) over (order by day rows between unbounded preceding and 1 preceding), 0)
                as bigint) as before
              from (select date '2024-02-14' + cast(event_id // 500 % 2 as integer) as day, count(*) as trades
                    from events group by 1))""",
    "fetch_after_failures": """select page_id, html, case when page_id % 7 = 0 then 2 else 1 end as times
        from pages""",
    "payload_types": "\nunion all ".join([
        _MANY % ("quantity", "VARIANT", "'double'", ""),
        _MANY % ("lineNumber", "DECIMAL", "'int'", " where l_linenumber = 1"),
        _MANY % ("remark", "STRING", "null", " where l_linenumber = 1")]),
    "append_counts": _bars(f"""select load, n as sent, nulls as null_keys, added, n - nulls - added as repeated from (
        select 0 as load, count(*) as n, count(*) filter (day(time_stamp) % 7 = 0) as nulls,
          count(*) filter (day(time_stamp) % 7 <> 0) as added from bars where {_EARLY}
        union all select 1, 2 * count(*), 2 * count(*) filter (day(time_stamp) % 7 = 0), 0 from bars where {_EARLY}
        union all select 2, count(*), count(*) filter (day(time_stamp) % 7 = 0),
          count(*) filter (not ({_EARLY})) from bars)"""),
    "schema_probe": _bars("\nunion all ".join(
        f"select {i} as place, '{f.name}' as column_name, '{f.dataType.simpleString()}' as type, "
        f"count({f.name}) as present from bars" for i, f in enumerate(TABLES["stock_history"].schema))),
    "empty_relation": _bars("select ticker, time_stamp, round(close, 8) as close, volume from bars"),
    "initial_load_resumed": _all(
        STATEMENT_ROWS, BARS, SECONDS, INDICATORS,
        counts=[_company_counts("customer")[0], _counts("valuation_rating", "customer", "sum(c_acctbal)"),
                next(c for c in _statement_counts("statement") if "'cash_flow'" in c),
                *_bar_counts("bars", "derived"),
                *(f"select 'step {name}', 1, null" for name in ("companies", "ratings", "statements", "bars",
                                                                "indicators"))]),
    "indicators_of_buckets": _indicators(_INDICATOR_ROWS),
    "daily_refresh_30_days": _indicators(_INDICATOR_ROWS + " where time_stamp < timestamp '1998-07-31'"),
    "refresh_reconciled": _indicators(_INDICATOR_ROWS + " where time_stamp < timestamp '1998-09-01'"),
}
