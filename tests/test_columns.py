import datetime

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fieldbook import functions as fn
from fieldbook.schemas import ACS_AGE_UPPER, acs_age_label, age_labels


def values(spark, kind, items, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select("i", expr(F.col("v")).alias("o")).orderBy("i").select("o").collect()]


def test_labels(spark):
    assert values(spark, "int", [1, 2, None, 3], fn.label_sex) == ["Male", "Female", None, None]
    assert values(spark, "int", [1, 0, None], fn.label_res) == ["Resident", "Nonresident", None]


def test_age_category(spark):
    ages = [-1, 0, 17, 18, 24, 25, 64, 65, 99, None]
    expected = [None, "0-17", "0-17", "18-24", "18-24", "25-34", "55-64", "65+", "65+", None]
    assert values(spark, "int", ages, fn.age_category) == expected
    assert values(spark, "int", [5, 10, 30], lambda c: fn.age_category(c, (10, 20))) == [None, "10-19", "20+"]


def test_month_to_quarter(spark):
    months = [-1, 0, 3, 4, 6, 7, 9, 10, 12, 13, None]
    assert values(spark, "int", months, fn.month_to_quarter) == [1, 1, 1, 2, 2, 3, 3, 4, 4, 4, 4]
    fiscal = fn.quarter_by_breaks(9, 12, 15)
    assert values(spark, "int", [7, 9, 10, 13, 16, 18], fiscal) == [1, 1, 2, 3, 4, 4]


def test_relative_month(spark):
    df = spark.createDataFrame(
        [(datetime.date(2017, 11, 5), 2018, -1), (datetime.date(2017, 12, 31), 2018, 0),
         (datetime.date(2018, 1, 1), 2018, 1), (datetime.date(2019, 1, 1), 2018, 13)],
        "dot date, y int, want int",
    )
    assert all(r.got == r.want for r in df.select(fn.relative_month(F.col("dot"), F.col("y")).alias("got"), "want").collect())


def test_short_fips(spark):
    assert values(spark, "int", [1001, 19001, 19187, None], fn.short_fips) == [1, 1, 187, None]
    with pytest.raises(PySparkException):
        values(spark, "int", [101], fn.short_fips)


def test_strict_aggregates(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1), ("b", None), ("c", None)], "g string, v int")
    out = df.groupBy("g").agg(fn.strict_sum(F.col("v")).alias("s"), fn.strict_mean(F.col("v")).alias("m"))
    assert rows(out) == [("a", 1, 0.5), ("b", None, None), ("c", None, None)]


def test_acs_labels_nest_in_age_categories():
    bounds = {17, 24, 34, 44, 54, 64}
    assert bounds <= set(ACS_AGE_UPPER)
    assert len({acs_age_label(a) for a in range(101)}) == len(ACS_AGE_UPPER)
    assert acs_age_label(0) == "Under 5 years" and acs_age_label(20) == "20 years"
    assert acs_age_label(18) == "18 and 19 years" and acs_age_label(30) == "30 to 34 years"
    assert acs_age_label(100) == "85 years and over"
    assert age_labels() == ["0-17", "18-24", "25-34", "35-44", "45-54", "55-64", "65+"]
