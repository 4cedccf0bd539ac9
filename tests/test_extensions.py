"""Exact scale-up, points in outlines, quarantine, and histories pruned by a join."""

import math
import random
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from fieldbook.functions import apportioned
from fieldbook.operators import checks, dashboard as D, geography, metrics as M
from fieldbook.session import fresh_path
from fieldbook.sources import loaders as L, writers as W
from fieldbook.sources.store import FileStore
from fieldbook.workbook.queries import Desk, registered


def largest_remainders(values, total):
    known = sum(values.values())
    if not known:
        return dict.fromkeys(values)
    low = {k: v * total // known for k, v in values.items()}
    left = total - sum(low.values())
    for k in sorted(values, key=lambda k: (-(values[k] * total % known), k))[:left]:
        low[k] += 1
    return low


def test_apportioned_against_python(spark):
    rng = random.Random(3)
    data, want = [], []
    for g in range(60):
        values = {f"c{i}": rng.choice([0, 1, 3, rng.randrange(1000), 10**9 + rng.randrange(10**6)]) for i in range(rng.randint(1, 9))}
        total = rng.choice([0, 1, 7, sum(values.values()), rng.randrange(1, 4 * 10**9)])
        data += [(g, k, v, total) for k, v in values.items()]
        want += [(g, k, u) for k, u in largest_remainders(values, total).items()]
    df = spark.createDataFrame(data, "g int, c string, v long, total long")
    got = df.withColumn("u", apportioned("v", F.col("total"), ["g"], "c"))
    assert rows(got.select("g", "c", "u")) == sorted(want, key=lambda t: (t[0], t[1]))


def test_exact_scale_up_adds_up_where_rounding_does_not(spark):
    part = spark.createDataFrame([("a", 2000, 1), ("b", 2000, 1), ("c", 2000, 1)], "sex string, year int, participants long")
    total = spark.createDataFrame([("All", 2000, 5)], "tot string, year int, participants long")
    assert sum(r[2] for r in rows(M.scaleup_part(part, total))) == 6
    assert rows(M.scaleup_part(part, total, exact=True)) == [("a", 2000, 2), ("b", 2000, 2), ("c", 2000, 1)]


@pytest.mark.parametrize("name", ["scaleup_exact", "calc_part_exact"])
def test_every_segment_adds_up(spark, sf_dir, name):
    out = registered()[name](spark, sf_dir)
    by = [c for c in ("permission", "year") if c in out.columns]
    sums = out.filter("segment <> 'county'").groupBy(*by, "segment").agg(F.sum("participants").alias("n"))
    assert sums.groupBy(*by).agg(F.count_distinct("n").alias("k")).filter("k > 1").count() == 0
    if name == "calc_part_exact":
        home = out.filter("segment = 'res' and category = 'Resident'").select("year", F.col("participants").alias("want"))
        county = out.filter("segment = 'county'").groupBy("year").agg(F.sum("residents").alias("n"))
        assert county.join(home, "year").filter("n <> want").count() == 0 < county.count()


# ---- categories without people


def test_fill_missing_categories(spark):
    schema = "quarter int, `group` string, segment string, year int, category string, metric string, value double"
    dash = spark.createDataFrame(
        [(2, "deer", "All", 2000, "All", "participants", 5.0), (2, "deer", "Gender", 2000, "Male", "participants", 5.0), (2, "deer", "All", 2000, "All", "churn", 0.5), (2, "deer", "month", 2000, "1", "participants", 5.0)], schema
    )
    out = D.fill_missing_categories(dash)
    new = out.exceptAll(dash)
    assert new.groupBy("segment").count().collect() != [] and {(r["segment"], r["count"]) for r in new.groupBy("segment").count().collect()} == {("Residency", 2), ("Gender", 1), ("Age", 7)}
    assert {(r["metric"], r["value"]) for r in new.collect()} == {("participants", 0.0)}
    assert rows(D.fill_missing_categories(out)) == rows(out)  # nothing is filled twice
    assert D.fill_missing_categories(dash, {"Gender": ["Male"]}, ["churn"]).filter("metric = 'churn' and segment = 'Gender'").count() == 1
    assert D.fill_missing_categories(dash.limit(0)).count() == 0


# ---- points in outlines

STAR = [(math.cos(a) * r * 3 + 1, math.sin(a) * r * 2 - 1) for a, r in ((i * math.pi / 5 + 0.1, 1 if i % 2 else 0.35) for i in range(10))]
OUTLINES = {19001: STAR, 19003: [(-2, -2), (3, -2), (3, 3), (-2, 3)], 19005: [(5, 5), (6, 5), (6, 6), (5.2, 5.1)], 19007: [(3, -2), (8, -2), (8, 3), (3, 3)]}


def ray(x, y, ring):
    inside = False
    for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], ring[0]]):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            inside = not inside
    return inside


@pytest.mark.parametrize("cell", [0.3, 1.0, 50.0])
def test_county_of_point_equals_ray_casting(spark, cell):
    rng = random.Random(5)
    points = [(i, rng.uniform(-4, 9), rng.uniform(-4, 7)) for i in range(800)]
    points += [(900 + i, x, y) for i, (x, y) in enumerate([(-2.0, -2.0), (3.0, 0.0), (8.0, 0.0), (0.0, 3.0), (1.0, -1.0), (5.5, 5.05)])]
    vertices = [(f, n, float(x), float(y)) for f, ring in OUTLINES.items() for n, (x, y) in enumerate(ring)]
    rng.shuffle(vertices)
    county_map = spark.createDataFrame([*vertices, (None, 0, 0.0, 0.0)], "county_fips int, seq int, long double, lat double")
    df = spark.createDataFrame([*points, points[0], (1000, None, 1.0), (None, 1.0, 1.0)], "id int, long double, lat double").withColumn("county_fips", F.lit("old"))
    got = geography.county_of_point(df, county_map, cell)
    assert got.count() == len(points) + 3 and got.columns == ["id", "long", "lat", "county_fips"]
    want = {i: min((f for f, ring in OUTLINES.items() if ray(x, y, ring)), default=None) for i, x, y in points}
    assert {r["id"]: r["county_fips"] for r in got.collect() if r["id"] in want} == want
    assert len(set(want.values())) == 5
    assert [r["county_fips"] for r in got.where("id = 1000").collect()] == [None]
    assert geography.county_of_point(df, county_map.limit(0), cell).where("county_fips is not null").count() == 0
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text


# ---- quarantine


def test_quarantine_tags_every_reason_once(spark):
    cust = spark.createDataFrame([(1,), (2,), (2,), (None,)], "cust_id long")
    lic = spark.createDataFrame([(10,)], "lic_id long")
    sale = spark.createDataFrame(
        [(1, 10, 2001, 5, 1), (2, 10, 2001, 5, None), (3, 10, 2001, 5, 1), (None, None, 2001, 5, 0), (2, 11, 1999, 16, 7), (2, 10, None, None, 1), (2, 11, 1999, 16, 7)],
        "cust_id long, lic_id long, year int, month int, res int",
    )
    passed, held = checks.quarantine_sales(cust, lic, sale, max_year=2001)
    assert rows(passed) == [(1, 10, 2001, 5, 1), (2, 10, 2001, 5, None), (None, None, 2001, 5, 0)]
    assert sorted((r["cust_id"], ",".join(r["reasons"])) for r in held.collect()) == [(2, "year,month"), (2, "year,month,res,lic_id"), (2, "year,month,res,lic_id"), (3, "cust_id")]
    report = {(r["check"], r["column"]): r["n_bad"] for r in checks.quarantine_counts(held).collect()}
    counted = checks.check_allowed_values(cust, lic, sale, max_year=2001).unionByName(checks.check_foreign_keys(cust, lic, sale))
    assert report == {(r["check"], r["column"]): r["n_bad"] for r in counted.filter("table = 'sale'").collect()}
    assert checks.quarantine_sales(cust, lic, sale.drop("res", "lic_id"), 2001)[1].count() == 4
    assert [p.count() for p in checks.quarantine_sales(cust, lic, sale.limit(0), 2001)] == [0, 0]


def test_quarantine_reads_sales_once(spark, sf_dir):
    desk = Desk(spark, sf_dir)
    _, held = checks.quarantine_sales(desk.cust, desk.lic, desk.sale, max_year=2001)
    text = held._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet \[l_orderkey", text)) == 1


# ---- pruning by a join


def scan_files(df):
    """Files that the scan of history has read, from the metrics of the executed plan."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found, todo = [], [plan]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStage"):
            todo.append(node.plan())
            continue
        if name.startswith("Scan parquet") and "duration_run" in node.schema().toString():
            found.append(node.metrics().apply("numFiles").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return sum(found)


def test_histories_are_pruned_by_what_the_join_finds(spark):
    root = fresh_path(spark, "pruned")
    names = [f"p{i}" for i in range(8)]
    history = spark.createDataFrame([(n, c, 2000, 1) for n in names for c in range(20)], "permission string, cust_id long, year int, duration_run int")
    W.write_history(history, f"{root}/history", groups=names)
    spark.createDataFrame([(n, i) for i, n in enumerate(names)], "permission string, lic_id long").write.parquet(f"{root}/permission")
    spark.createDataFrame([(i, "deer" if i in (2, 5) else "trout") for i in range(8)], "lic_id long, priv string").write.parquet(f"{root}/lic")
    store = FileStore(spark, root)
    out = L.load_histories(store, L.permissions_of(store, store.table("lic").filter("priv = 'deer'")), [2000])
    assert "dynamicpruning" in out._jdf.queryExecution().executedPlan().toString().lower()
    assert {r["permission"] for r in out.select("permission").distinct().collect()} == {"p2", "p5"}
    assert scan_files(out) == 2 < len(store.table("history").inputFiles())
    assert scan_files(L.load_histories(store, L.permissions_of(store, store.table("lic")), [2000])) == 8
