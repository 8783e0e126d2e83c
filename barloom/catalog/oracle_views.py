"""The fixture views as SQL, to be put before an oracle query."""

BARS = """bars as (
  select p_brand as ticker, l_shipdate as time_stamp,
         first(l_extendedprice / l_quantity order by l_extendedprice, l_quantity) as open,
         max(l_extendedprice / l_quantity) as high,
         min(l_extendedprice / l_quantity) as low,
         last(l_extendedprice / l_quantity order by l_extendedprice, l_quantity) as close,
         cast(sum(l_quantity) as bigint) as volume
  from lineitem join part on l_partkey = p_partkey
  group by 1, 2)"""

SECONDS = """timed as (
  select *, cast(epoch(time_stamp) as bigint) as sec,
         (high + low + close) / 3 as typical_price from bars)"""

FRAME = "(partition by ticker order by sec range between 2629800 preceding and current row)"
SERIES = "(partition by ticker order by sec)"

INDICATORS = f"""meaned as (
  select *, avg(volume) over {FRAME} as sma,
         lag(typical_price) over {SERIES} as lag_typical_price from timed),
signed as (
  select *, power(close - sma, 2) as distance,
         case when lag_typical_price < typical_price then typical_price else 0.0 end as positive,
         case when lag_typical_price > typical_price then typical_price else 0.0 end as negative
  from meaned),
summed as (
  select *, sqrt(sum(distance) over {FRAME} / 30) as deviation,
         sum(positive) over {FRAME} / nullif(sum(negative) over {FRAME}, 0) as ratio
  from signed),
derived as (
  select *, volume + deviation as lower_bollinger, volume - deviation as higher_bollinger,
         100 - 100 / nullif(1 - ratio, 0) as money_flow
  from summed)"""


def with_views(*views: str, query: str) -> str:
    return "with " + ",\n".join(views) + "\n" + query
