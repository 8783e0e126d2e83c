import pytest

from barloom.functions.naming import camel_map, snake_map, snake_name, to_camel, to_snake
from barloom.model import CHILDREN, ENDPOINTS, MASTER, RATINGS, STATEMENTS, TABLES, service_name

VECTORS = {
    "avgROE": "avg_ro_e", "last5yearsEBITDAGrowth": "last5years_eb_it_da_growth",
    "last5yearsFCFFGrowth": "last5years_fc_ff_growth", "TOIGrowth": "t_oi_growth",
    "netIncomeTOI": "net_income_to_i", "netDebtEBITDA": "net_debt_eb_it_da",
    "priceChange3m": "price_change3m", "industryIDv2": "industry_idv2", "ticker": "ticker",
    "Ticker": "ticker", "": "",
}


@pytest.mark.parametrize("camel", VECTORS)
def test_snake_name(camel):
    assert snake_name(camel) == VECTORS[camel]


def test_every_stored_name_is_stable_and_comes_back_from_its_service_name():
    for table in TABLES.values():
        for column in table.columns:
            assert snake_name(column) == column
            assert snake_name(service_name(column)) == column


def test_colliding_names_are_an_error():
    with pytest.raises(ValueError):
        snake_map(["assetValue", "asset_value"])


def test_round_trip(spark):
    df = spark.range(1).toDF("avgROE").selectExpr("avgROE", "1 as netIncomeTOI")
    mapping = snake_map(df.columns)
    assert to_snake(df).columns == ["avg_ro_e", "net_income_to_i"]
    assert to_camel(to_snake(df), mapping).columns == df.columns
    assert camel_map(mapping) == {"avg_ro_e": "avgROE", "net_income_to_i": "netIncomeTOI"}


def test_tables():
    sizes = [len(t.columns) for t in TABLES.values()]
    assert sizes == [9, 11, 7, 6, 24, 37, 8, 59, 12, 16, 14, 22, 14, 10, 14]
    assert len(CHILDREN) == 14
    assert TABLES["business_model_rating"].key == ("ticker", "year", "quarter")
    assert TABLES["listing_companies"].widths["exchange"] == 5
    assert all(set(t.key) <= set(t.columns) for t in TABLES.values())


def test_endpoints():
    assert set(ENDPOINTS) == set(TABLES) - {"companies_info", "derived_stock_history"} | {MASTER}
    assert all(ENDPOINTS[n].kind == "array" and ENDPOINTS[n].flags == 2 for n in STATEMENTS)
    assert all(ENDPOINTS[n].kind == "object" and ENDPOINTS[n].flags == 1 for n in RATINGS)
    assert ENDPOINTS["industry_financial_health"].path.endswith("fType=INDUSTRY")
