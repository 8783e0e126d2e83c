"""Declared schemas: the 15 tables, their keys, and the payloads they are filled from."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from barloom.functions.naming import snake_name

_TYPES = {
    "double": T.DoubleType(), "int": T.IntegerType(), "long": T.LongType(),
    "bool": T.BooleanType(), "ts": T.TimestampType(), "text": T.StringType(),
}


@dataclass(frozen=True)
class Table:
    """Schema in stored order, key, text widths, required columns and partition column."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    widths: dict[str, int] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    year_of: str | None = None  # timestamp column whose year the files are partitioned by

    @property
    def columns(self) -> list[str]:
        return self.schema.names


def _table(name: str, key: str, columns: str, year_of: str | None = None) -> Table:
    """``columns``: names in stored order, double unless ``:type`` or ``:width`` says otherwise."""
    fields, widths = [], {}
    for token in columns.split():
        column, _, kind = token.partition(":")
        if kind.isdigit():
            widths[column], kind = int(kind), "text"
        fields.append(T.StructField(column, _TYPES[kind or "double"]))
    keys = tuple(key.split())
    required = tuple(f.name for f in fields if f.name in keys)
    return Table(name, T.StructType(fields), keys, widths, required, year_of)


_PERIOD_KEY = "ticker year quarter"
_PERIOD = "ticker:8 year:int quarter:int"
# Column names and their order, as stored.
_HEALTH = """loan_deposit bad_loan_gross_loan bad_loan_asset provision_bad_loan financial_health
    net_debt_equity current_ratio quick_ratio interest_coverage net_debt_eb_it_da"""

TABLES: dict[str, Table] = {t.name: t for t in [
    _table("listing_companies", "ticker", """ticker:8 exchange:5 short_name:256 industry_id
        industry_idv2:int industry:256 industry_en:256 established_year:int company_type:2"""),
    _table("companies_info", "ticker", """ticker:8 no_employees:int no_shareholders:int
        foreign_percent website:256 stock_rating delta_in_week delta_in_month delta_in_year
        outstanding_share issue_share"""),
    _table("stock_history", "ticker time_stamp", """ticker:8 time_stamp:ts open high low close
        volume:long""", year_of="time_stamp"),
    _table("derived_stock_history", "ticker time_stamp", """ticker:8 time_stamp:ts sma
        lower_bollinger higher_bollinger money_flow""", year_of="time_stamp"),
    _table("income_statement", _PERIOD_KEY, f"""{_PERIOD} revenue:long year_revenue_growth
        quarter_revenue_growth cost_of_good_sold gross_profit operation_expense:long
        operation_profit:long year_operation_profit_growth quarter_operation_profit_growth
        interest_expense pre_tax_profit:long post_tax_profit:long share_holder_income:long
        year_share_holder_income_growth quarter_share_holder_income_growth invest_profit
        service_profit other_profit provision_expense operation_income ebitda"""),
    _table("balance_sheet", _PERIOD_KEY, f"""{_PERIOD} short_asset cash:long short_invest
        short_receivable inventory long_asset fixed_asset:long asset:long debt:long short_debt
        long_debt equity:long capital:long central_bank_deposit other_bank_deposit
        other_bank_loan stock_invest customer_loan bad_loan provision net_customer_loan
        other_asset other_bank_credit owe_other_bank owe_central_bank valuable_paper
        payable_interest receivable_interest deposit other_debt:long fund un_distributed_income
        minor_share_holder_profit payable:long"""),
    _table("cash_flow", _PERIOD_KEY, f"""{_PERIOD} invest_cost:long from_invest:long
        from_financial:long from_sale:long free_cash_flow"""),
    _table("financial_ratio", _PERIOD_KEY, f"""{_PERIOD} price_to_earning price_to_book
        value_before_ebitda dividend roe roa days_receivable days_inventory days_payable
        ebit_on_interest earning_per_share:long book_value_per_share interest_margin
        non_interest_on_toi bad_debt_percentage provision_on_bad_debt cost_of_financing
        equity_on_total_asset equity_on_loan cost_to_income equity_on_liability current_payment
        quick_payment eps_change ebitda_on_stock gross_profit_margin operating_profit_margin
        post_tax_margin debt_on_equity debt_on_asset debt_on_ebitda short_on_long_debt
        asset_on_equity capital_balance cash_on_equity cash_on_capitalize cash_circulation
        revenue_on_work_capital capex_on_fixed_asset revenue_on_asset post_tax_on_pre_tax
        ebit_on_revenue pre_tax_on_ebit pre_provision_on_toi post_tax_on_toi loan_on_earn_asset
        loan_on_asset loan_on_deposit deposit_on_earn_asset bad_debt_on_asset
        liquidity_on_liability payable_on_equity cancel_debt ebitda_on_stock_change
        book_value_per_share_change credit_growth"""),
    _table("stock_intraday_transaction", "id time_stamp", """id:long price volume:long cp rcp a:2
        ba sa hl:bool pcp time_stamp:ts ticker:8""", year_of="time_stamp"),
    _table("general_rating", _PERIOD_KEY, f"""{_PERIOD} stock_rating valuation financial_health
        business_model business_operation rs_rating ta_score highest_price lowest_price
        price_change3m price_change1y beta alpha"""),
    _table("business_model_rating", _PERIOD_KEY, f"""{_PERIOD} business_model
        business_efficiency asset_quality cash_flow_quality bom business_administration
        product_service business_advantage company_position industry operation_risk"""),
    _table("business_operation_rating", _PERIOD_KEY, f"""{_PERIOD} industry_en:256 loan_growth
        deposit_growth net_interest_income_growth net_interest_margin cost_to_income
        net_income_to_i business_operation avg_ro_e avg_ro_a last5years_net_profit_growth
        last5years_revenue_growth last5years_operating_profit_growth
        last5years_eb_it_da_growth last5years_fc_ff_growth last_year_gross_profit_margin
        last_year_operating_profit_margin last_year_net_profit_margin t_oi_growth"""),
    _table("financial_health_rating", _PERIOD_KEY, f"{_PERIOD} industry_en:256 {_HEALTH}"),
    _table("valuation_rating", _PERIOD_KEY,
           f"{_PERIOD} industry_en:256 valuation pe pb ps evebitda dividend_rate"),
    _table("industry_financial_health", _PERIOD_KEY, f"{_PERIOD} industry_en:256 {_HEALTH}"),
]}

# Every table but the listing refers to it.
PARENT, PARENT_KEY = "listing_companies", "ticker"
CHILDREN = [name for name in TABLES if name != PARENT]

# Service names that capital runs keep from being rebuilt from the stored name.
_SERVICE_NAMES = ["avgROE", "avgROA", "last5yearsEBITDAGrowth", "last5yearsFCFFGrowth",
                  "TOIGrowth", "netIncomeTOI", "netDebtEBITDA", "industryID", "industryIDv2"]
_BY_STORED_NAME = {snake_name(name): name for name in _SERVICE_NAMES}


def service_name(stored: str) -> str:
    """The camelCase payload key of a stored column."""
    if stored in _BY_STORED_NAME:
        return _BY_STORED_NAME[stored]
    head, *rest = stored.split("_")
    return head + "".join(word[:1].upper() + word[1:] for word in rest)


def payload_schema(fields: T.StructType) -> T.StructType:
    """The same fields under the names the payloads use."""
    return T.StructType([T.StructField(service_name(f.name), f.dataType) for f in fields])


def _rows(columns: str) -> T.StructType:
    return T.StructType([T.StructField(n, _TYPES[k or "double"]) for n, _, k in
                         (token.partition(":") for token in columns.split())])


# Payload fields of the two wrapped datasets, and of the overview.
BAR_ROW = _rows("open high low close volume:long tradingDate:text")
TRADE_ROW = _rows("p v:long cp rcp a:text ba sa hl:bool pcp t:text")
TRADE_NAMES = {"p": "price", "v": "volume"}
PAGE_HEADER = _rows("page:int size:int headIndex:int numberOfItems:int total:int ticker:text")
OVERVIEW = T.StructType(
    [f for f in TABLES["listing_companies"].schema if f.name != "ticker"]
    + [f for f in TABLES["companies_info"].schema]
)

STATEMENTS = ["balance_sheet", "income_statement", "cash_flow", "financial_ratio"]
RATINGS = ["general_rating", "business_model_rating", "business_operation_rating",
           "financial_health_rating", "valuation_rating", "industry_financial_health"]


@dataclass(frozen=True)
class Endpoint:
    """How a dataset is asked for and what comes back."""

    dataset: str
    kind: str  # "object", "array" or "wrapped"
    path: str  # with {ticker}, {flag}, {start}, {end}
    flags: int  # requests per ticker: flag 0 .. flags - 1
    schema: T.StructType


MASTER = "master_list"  # not a table: the tickers that everything else is asked for by
MASTER_LIST = T.StructType([T.StructField("items", T.ArrayType(
    T.StructType([T.StructField("ticker", T.StringType())])))])


def _endpoints() -> dict[str, Endpoint]:
    """Paths are relative; the transport knows the host. The paths."""
    report = "finance/{ticker}/%s?yearly={flag}&isAll=True"
    rating = "rating/{ticker}/%s"
    found = [
        Endpoint(MASTER, "object", "Master/GetListOrganization?language=vi", 1, MASTER_LIST),
        Endpoint("listing_companies", "object", "ticker/{ticker}/overview", 1,
                 payload_schema(OVERVIEW)),
        Endpoint("stock_history", "wrapped",
                 "bars-long-term?ticker={ticker}&type=stock&resolution=D&from={start}&to={end}",
                 1, BAR_ROW),
        Endpoint("stock_intraday_transaction", "wrapped",
                 "intraday/{ticker}/his/paging?page=0&size=100000", 1, TRADE_ROW),
    ]
    for name in STATEMENTS:
        found.append(Endpoint(name, "array", report % name.replace("_", ""), 2,
                              payload_schema(TABLES[name].schema)))
    for name in RATINGS:
        kind = name.removesuffix("_rating").replace("_", "-") + "?fType=TICKER"
        if name == "industry_financial_health":
            kind = "financial-health?fType=INDUSTRY"
        found.append(Endpoint(name, "object", rating % kind, 1,
                              payload_schema(TABLES[name].schema)))
    return {e.dataset: e for e in found}


ENDPOINTS = _endpoints()
