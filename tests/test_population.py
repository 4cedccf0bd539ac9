import pytest
from conftest import rows
from pyspark.sql import functions as F

from fieldbook.operators import population as N

POP = "county_fips int, year int, sex int, age int, pop long"


def test_age_map(spark):
    ages = N.age_map(spark)
    assert ages.count() == 101
    assert rows(ages.filter("age_year in (17, 18, 65, 100)")) == [
        (17, 1, "15 to 17 years"), (18, 2, "18 and 19 years"), (65, 7, "65 and 66 years"), (100, 7, "85 years and over"),
    ]


def test_factor_age_acs(spark):
    pop = spark.createDataFrame([("20 years", 5), ("Under 5 years", 7), ("unheard of", 9)], "age_acs string, pop int")
    out = N.factor_age_acs(pop, N.age_map(spark)).select("age_acs", "age_acs_ord", "pop")
    assert rows(out) == [("20 years", 20, 5), ("Under 5 years", 0, 7), (None, None, 9)]
    check = N.age_acs_check(pop, N.age_map(spark)).filter("new is null")
    assert rows(check) == [(None, "unheard of", 1)]


def test_aggregate_pop_is_strict(spark):
    pop = spark.createDataFrame([(1, 2000, 1, 1, 5), (1, 2000, 1, 1, 6), (2, 2000, 1, 1, 5), (2, 2000, 1, 1, None)], POP)
    assert rows(N.aggregate_pop(pop)) == [(1, 2000, 1, 1, 11), (2, 2000, 1, 1, None)]


def test_extrapolate_pop(spark):
    pop = spark.createDataFrame([(1, 2000, 1, 1, 100), (1, 2001, 1, 1, 110), (1, 2002, 1, 1, 99)], POP)
    growth = (110 / 100 + 99 / 110) / 2
    out = {r.year: r["pop"] for r in N.extrapolate_pop(pop, range(2000, 2005)).collect()}
    assert sorted(out) == [2000, 2001, 2002, 2003, 2004]
    assert out[2002] == 99 and out[2003] == pytest.approx(99 * growth) and out[2004] == pytest.approx(99 * growth**2)
    check = N.extrapolation_check(pop, range(2000, 2005)).first()
    assert (check.last_year, check.n_extrapolated) == (2002, 2) and check.growth == pytest.approx(growth)


def test_extrapolate_nothing_missing(spark):
    pop = spark.createDataFrame([(1, 2000, 1, 1, 100), (1, 2001, 1, 1, 110)], POP)
    assert rows(N.extrapolate_pop(pop, [2000, 2001])) == [(1, 2000, 1, 1, 100.0), (1, 2001, 1, 1, 110.0)]


def test_extrapolate_gap_and_zero_and_single_year(spark):
    gap = spark.createDataFrame([(1, 2000, 1, 1, 0), (1, 2003, 1, 1, 100), (1, 2005, 1, 1, 150)], POP)
    assert N.growth_rate(gap).first().growth == pytest.approx(1.5)  # a zero year has no ratio
    one = spark.createDataFrame([(1, 2000, 1, 1, 100)], POP)
    out = {r.year: r["pop"] for r in N.extrapolate_pop(one, [2000, 2001]).collect()}
    assert out == {2000: 100.0, 2001: None}


def test_prep_and_est_pop(spark):
    pop = spark.createDataFrame(
        [(1, y, s, a, 10 * s + a) for y in (1999, 2000, 2001) for s in (1, 2) for a in (1, 7)], POP
    )
    ready = N.prep_pop(pop, [2000, 2001])
    assert set(ready.columns) == {"county_fips", "year", "sex", "agecat", "pop"}
    assert rows(ready.select("sex", "agecat", "year", "pop").filter("year = 2000")) == [
        ("Female", "0-17", 2000, 21.0), ("Female", "65+", 2000, 27.0), ("Male", "0-17", 2000, 11.0), ("Male", "65+", 2000, 17.0),
    ]
    assert rows(N.est_pop(ready, "tot")) == [(2000, 76.0), (2001, 76.0)]
    assert rows(N.est_pop(ready, "sex").filter(F.col("year") == 2001)) == [("Female", 2001, 48.0), ("Male", 2001, 28.0)]


def test_no_population_at_all(spark):
    """Nothing to grow, nothing lost: rates over it are NULL, and the check says so."""
    empty = spark.createDataFrame([], "county_fips int, year int, sex int, age int, pop long")
    assert N.extrapolate_pop(empty, [2000, 2001]).collect() == []
    assert [tuple(r) for r in N.extrapolation_check(empty, [2000, 2001]).collect()] == [(None, None, 2)]
