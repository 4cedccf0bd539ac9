import hashlib

import pytest
from conftest import rows
from pyspark.sql import Observation, functions as F

from fieldbook.operators import dive, geography, permissions, sampling
from fieldbook.plans.dive import hist_samp


@pytest.fixture(scope="module")
def outline(spark):
    return spark.createDataFrame(
        [(float(x), float(x), x, c, f) for f, c in ((19001, "Adair"), (19003, "Boone")) for x in (1, 2, 3)],
        "long double, lat double, seq int, county string, county_fips int",
    )


def test_set_other_county_na(spark, outline):
    cust = spark.createDataFrame([(1, 19001), (2, 55001), (3, None), (4, 55001)], "cust_id long, county_fips int")
    seen = Observation()
    out = geography.set_other_county_na(cust, outline.withColumnRenamed("county_fips", "fips"), seen)
    assert rows(out) == [(1, 19001), (2, None), (3, None), (4, None)]
    assert seen.get == {"other_state": 2}


def test_set_nonres_county_na(spark):
    frame = spark.createDataFrame([(1, 1, 19001), (2, 0, 19001), (3, None, 19001)], "cust_id long, res int, county_fips int")
    assert rows(geography.set_nonres_county_na(frame)) == [(1, 1, 19001), (2, 0, None), (3, None, None)]


def test_county_from_zip(spark):
    cust = spark.createDataFrame([(1, 50001, None), (2, 50001, 19003), (3, 50009, None), (4, None, None)], "cust_id long, zip int, county_fips int")
    crosswalk = spark.createDataFrame([(50001, 19001)], "zip int, county_fips int")
    assert rows(geography.county_from_zip(cust, crosswalk)) == [(1, 50001, 19001), (2, 50001, 19003), (3, 50009, None), (4, None, None)]


def test_join_county_map(spark, outline):
    dash = spark.createDataFrame(
        [("County", "Adair", 1.0), ("County", "Cass", 2.0), ("County", "Nowhere", 3.0), ("Gender", "Male", 4.0)],
        "segment string, category string, value double",
    )
    census = spark.createDataFrame([(19001, "Adair"), (19003, "Boone"), (19005, "Cass")], "county_fips int, county string")
    out = geography.join_county_map(dash, outline, census)
    assert rows(out.select("segment", "category", "county_fips", F.coalesce(F.size("outline"), F.lit(-1)))) == [
        ("county", "Adair", 19001, 3), ("county", "Cass", 19005, -1), ("county", "Nowhere", None, -1), ("gender", "Male", None, -1),
    ]
    assert [v.seq for v in out.filter("county_fips = 19001").first().outline] == [1, 2, 3]
    assert rows(geography.county_map_missing(dash, outline, census)) == [(1, 1)]


def test_exact_sample_is_smallest_digests(spark):
    ids = list(range(0, 3000, 3))
    customers = spark.createDataFrame([(i,) for i in ids], "cust_id long")
    for pct in (10, 33, 100, 0):
        want = sorted(ids, key=lambda i: hashlib.md5(f"{i}:42".encode()).hexdigest())[: round(len(ids) * pct / 100)]
        assert rows(sampling.sample_exact(customers, pct)) == sorted((i,) for i in want)
    again = sampling.sample_exact(customers.repartition(7), 10)
    assert rows(again) == rows(sampling.sample_exact(customers, 10))
    assert rows(sampling.sample_exact(customers, 10, seed=1)) != rows(again)


def test_hash_sample(spark):
    customers = spark.range(20000).select(F.col("id").alias("cust_id"))
    part = sampling.sample_by_hash(customers, 10)
    assert 1800 < part.count() < 2200
    half = customers.filter("cust_id < 10000")
    assert rows(sampling.sample_by_hash(half, 10)) == rows(part.filter("cust_id < 10000"))


SAMP = "priv string, cust_id long, year int, lapse int, R3 string, res string, sex string, fips int, age string"


@pytest.fixture(scope="module")
def samp(spark):
    return spark.createDataFrame(
        [
            ("deer", 1, 2000, 0, None, "Resident", "Male", 1, "18-24"),
            ("deer", 2, 2000, 1, None, "Resident", "Female", 1, "25-34"),
            ("deer", 3, 2000, 1, "Recruit", "Nonresident", None, None, "25-34"),
            ("deer", 4, 2000, 1, "Renew", "Resident", "Male", 3, None),
            ("deer", 1, 2001, None, "Renew", "Resident", "Male", 1, "18-24"),
            ("deer", 5, 2001, 0, "Reactivate", None, "Female", 3, "65+"),
            ("trout", 9, 2000, 0, "Renew", "Resident", "Male", 1, "65+"),
        ],
        SAMP,
    )


def test_filter_demo(samp):
    ids = lambda df: sorted((r.cust_id, r.year) for r in df.collect())
    deer = samp.filter("priv = 'deer'")
    assert ids(dive.filter_demo(deer, "sex", ["Male"])) == [(1, 2000), (1, 2001), (3, 2000), (4, 2000)]
    assert ids(dive.filter_demo(deer, "R3", ["Renew"])) == [(1, 2001), (4, 2000)]
    assert dive.filter_demo(deer, "sex", ["Female", "Male"]) is deer
    assert ids(dive.filter_demo(deer, "R3", ["Renew", "Recruit", "Reactivate"])) == ids(deer)


def test_summarize_trend(samp):
    deer = samp.filter("priv = 'deer'")
    assert rows(dive.summarize_trend(deer, pct=10)) == [(2000, 40.0), (2001, 20.0)]
    assert rows(dive.summarize_trend(deer, "sex", "age", pct=50)) == [
        ("Female", "25-34", 2000, 2.0), ("Female", "65+", 2001, 2.0), ("Male", "18-24", 2000, 2.0), ("Male", "18-24", 2001, 2.0),
    ]
    assert rows(dive.summarize_trend(deer, metric="churn")) == [(2001, 75.0)]
    assert rows(dive.summarize_trend(deer, "None", "sex", "churn")) == [("Female", 2001, 100.0), ("Female", 2002, 0.0), ("Male", 2001, 50.0)]
    grid = dive.trend_grid(dive.summarize_trend(deer, "age", "sex", pct=100), "sex", ["Male", "Female"])
    assert rows(grid) == [("18-24", 2000, 1.0, None), ("18-24", 2001, 1.0, None), ("25-34", 2000, None, 1.0), ("65+", 2001, None, 1.0)]


def test_distribution_keeps_unknown(samp):
    out = dive.distribution(samp.filter("priv = 'deer' and year = 2000"), "sex")
    assert rows(out) == [("Female", 1, 25.0), ("Male", 2, 50.0), (None, 1, 25.0)]


def test_county_values(samp):
    deer = samp.filter("priv = 'deer'")
    assert rows(dive.county_values(deer.filter("year = 2000"), pct=10)) == [(1, 20.0), (3, 10.0)]
    assert rows(dive.county_values(deer.filter("year = 2000"), "churn")) == [(1, 50.0), (3, 100.0)]
    assert rows(dive.county_values(deer, "churn")) == [(1, None), (3, 50.0)]


def test_dive_menu(samp):
    menu = dive.dive_menu(samp)
    assert [r.option for r in menu.filter("menu = 'year'").orderBy("ord").collect()] == ["2001", "2000"]
    assert rows(menu.filter("menu = 'priv'").select("option")) == [("deer",), ("trout",)]


def test_dive_spec(samp, outline):
    spec = dive.DiveSpec("deer", metric="churn", year=2001, selected={"res": ["Resident"]})
    codes = outline.withColumn("fips", F.col("county_fips") % 1000).drop("county_fips")
    assert rows(dive.dive_trend(samp, spec)) == [(2001, pytest.approx(200 / 3))]
    assert rows(dive.dive_county(samp, spec, codes).select("fips", "value").distinct()) == [(1, 50.0), (3, 100.0)]
    assert rows(dive.dive_distribution(samp, spec, "sex").select("sex", "n")) == [("Female", 1), ("Male", 1)]


def test_hist_samp_columns_and_clean_up(spark, outline):
    history = spark.createDataFrame(
        [("all_sports", c, 2000, 1, "Renew", 5, r) for c, r in ((1, 1), (2, 0), (3, 1), (4, None), (5, 1))] + [("deer", 1, 2000, 1, None, 5, 1)],
        "permission string, cust_id long, year int, lapse int, R3 string, month int, res int",
    )
    cust = spark.createDataFrame(
        [(1, 1, 1980, 19001), (2, 2, 1980, 19003), (3, None, None, 55001), (4, 1, 1999, 19001)],
        "cust_id long, sex int, birth_year int, county_fips int",
    )
    out = hist_samp(history, cust, outline.withColumnRenamed("county_fips", "fips"), pct=100)
    assert rows(out.select("priv", "cust_id", "res", "sex", "fips", "age")) == [
        ("all_sports", 1, "Resident", "Male", 1, "18-24"),
        ("all_sports", 2, "Nonresident", "Female", None, "18-24"),
        ("all_sports", 3, "Resident", None, None, None),
        ("all_sports", 4, None, "Male", None, "0-17"),
        ("all_sports", 5, "Resident", None, None, None),
        ("deer", 1, "Resident", "Male", 1, "18-24"),
    ]


def test_permissions(spark):
    sale = spark.createDataFrame(
        [(1, 1, 2000, 1), (1, 1, 2000, 1), (1, 2, 2000, 1), (None, 1, 2000, 2), (None, 1, 2000, 2), (2, 3, 2000, 1)],
        "cust_id long, lic_id long, year int, month int",
    )
    ids = spark.createDataFrame([(1,), (2,)], "lic_id long")
    assert rows(permissions.sale_group(sale, ids)) == [(1, 2000, 1), (None, 2000, 2)]
    table = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2), ("b", 3)], "permission string, lic_id long")
    assert rows(permissions.sale_groups(sale, table)) == [("a", 1, 2000, 1), ("a", None, 2000, 2), ("b", 1, 2000, 1), ("b", 2, 2000, 1)]
    seen = Observation()
    assert permissions.drop_na_custid(sale, seen).count() == 4
    assert seen.get == {"missing_cust_id": 2}
