import pytest
from conftest import rows

from fieldbook.operators import checks


@pytest.fixture(scope="module")
def tables(spark):
    cust = spark.createDataFrame(
        [(1, 1, 1950, 19001), (2, 3, 1850, 19003), (3, None, None, None), (3, 2, 2030, 19005), (None, 1, 1990, None)],
        "cust_id long, sex int, birth_year int, county_fips int",
    )
    lic = spark.createDataFrame(
        [(1, "fish", 1), (2, "boat", 0), (3, None, 100), (4, "hunt", None)], "lic_id long, type string, duration int"
    )
    sale = spark.createDataFrame(
        [(1, 1, 2005, 4, 1), (1, 9, 1999, 16, 2), (8, 2, 2025, -1, None), (8, 2, None, None, 0), (None, 1, 2010, 15, 0)],
        "cust_id long, lic_id long, year int, month int, res int",
    )
    return cust, lic, sale


def test_allowed_values(tables):
    out = checks.check_allowed_values(*tables, max_year=2024)
    assert rows(out.select("table", "column", "n_bad")) == [
        ("cust", "birth_year", 2), ("cust", "sex", 1), ("lic", "duration", 3), ("lic", "type", 2),
        ("sale", "month", 3), ("sale", "res", 1), ("sale", "year", 3),
    ]
    early = checks.check_allowed_values(*tables, max_year=2024, min_year=1995).filter("column = 'year'")
    assert rows(early.select("n_bad")) == [(2,)]


def test_keys(tables):
    cust, lic, sale = tables
    assert rows(checks.check_foreign_keys(cust, lic, sale).select("column", "n_bad")) == [("cust_id", 2), ("lic_id", 1)]
    assert rows(checks.check_primary_keys(cust, lic)) == [
        ("duplicate_key", "cust", "cust_id", 1), ("null_key", "cust", "cust_id", 1),
    ]


def test_fips(tables, spark):
    assert checks.check_fips_integer(tables[0]).count() == 0
    text = spark.createDataFrame([("19001",), ("A1",), (None,), ("x",)], "county_fips string")
    assert rows(checks.check_fips_integer(text)) == [
        ("integer_fips", "cust", "county_fips", 2), ("integer_fips_type", "cust", "county_fips", 1),
    ]
    half = spark.createDataFrame([(19001.5,), (19001.0,), (None,)], "county_fips double")
    assert rows(checks.check_fips_integer(half)) == [
        ("integer_fips", "cust", "county_fips", 1), ("integer_fips_type", "cust", "county_fips", 1),
    ]


def test_allowed_sets_can_be_given(tables):
    out = checks.check_allowed_values(
        *tables, max_year=2024, types=("fish", "boat", "hunt"), months=range(-2, 17), sexes=(1, 2, 3), residencies=(0, 1, 2),
        durations=range(0, 101), birth_years=range(1800, 2100),
    )
    assert rows(out.select("table", "column", "n_bad")) == [("lic", "duration", 1), ("lic", "type", 1), ("sale", "month", 1), ("sale", "year", 3)]


def test_checks_run_on_the_columns_there_are(tables):
    cust, lic, sale = tables
    out = checks.data_check(cust.drop("sex", "county_fips"), lic.drop("lic_id"), sale.drop("res", "month"), max_year=2024)
    found = {(r["check"], r["table"], r["column"]) for r in out.collect()}
    assert {("required_column", "cust", "sex"), ("required_column", "lic", "lic_id"), ("required_column", "sale", "res")} <= found
    assert ("allowed_values", "sale", "year") in found and ("foreign_key", "sale", "cust_id") in found
    assert not any(c == ("allowed_values", "cust", "sex") for c in found)


def test_data_check(tables):
    cust, lic, sale = tables
    clean_cust = cust.filter("cust_id = 1")
    clean_lic = lic.filter("lic_id = 1")
    clean_sale = sale.filter("cust_id = 1 and lic_id = 1")
    assert checks.data_check(clean_cust, clean_lic, clean_sale, max_year=2024).count() == 0
    missing = checks.missing_columns(cust.drop("sex"), "cust", ("cust_id", "sex"))
    assert rows(missing) == [("required_column", "cust", "sex", 1)]
