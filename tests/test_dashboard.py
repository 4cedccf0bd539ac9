import pytest
from conftest import rows
from pyspark.sql import functions as F

from fieldbook.operators import dashboard as D
from fieldbook.operators import segments as G
from fieldbook.operators import views

DASH = "quarter int, `group` string, segment string, year int, category string, metric string, value double"


@pytest.fixture(scope="module")
def dash(spark):
    return spark.createDataFrame(
        [
            (2, "hunt", "month", 2000, "1", "participants", 5.0), (2, "hunt", "month", 2000, "6", "participants", 7.0),
            (2, "fish", "month", 2000, "6", "participants", 2.0), (4, "hunt", "month", 2000, "9", "participants", 3.0),
            (4, "hunt", "month", 2000, "1", "recruits", 1.0),
            (2, "hunt", "All", 1999, "All", "participants", 100.0), (2, "hunt", "All", 2000, "All", "participants", 130.0),
            (2, "hunt", "All", 2002, "All", "participants", 10.0), (2, "hunt", "County", 2000, "Adair", "churn", 0.5),
            (2, "hunt", "Gender", 1999, "Male", "participants", 60.0), (2, "hunt", "Gender", 2000, "Male", "participants", 70.0),
            (2, "hunt", "Gender", 2000, "Female", "participants", 60.0),
        ],
        DASH,
    )


def test_fill_missing_months(dash):
    out = D.fill_missing_months(dash)
    added = rows(out.exceptAll(dash).select("quarter", "group", "category", "metric", "value"))
    assert added == [
        (2, "fish", "1", "participants", 0.0),
        (4, "hunt", "1", "participants", 0.0), (4, "hunt", "6", "participants", 0.0),
        (4, "hunt", "6", "recruits", 0.0), (4, "hunt", "9", "recruits", 0.0),
    ]
    assert rows(D.fill_missing_months(out)) == rows(out)
    everything = D.fill_missing_months(dash, {}).filter("quarter = 2 and category = '9'")
    assert everything.count() == 2


def test_format_metrics(spark):
    metrics = spark.createDataFrame(
        [("rate", s, "x", 2000, 1.0) for s in ("tot", "res", "sex", "agecat", "county", "month")],
        "metric string, segment string, category string, year int, value double",
    )
    out = D.format_metrics(metrics, 2, "ice fishing")
    assert {r.segment for r in out.collect()} == {"All", "Residency", "Gender", "Age", "County", "month"}
    assert {(r.quarter, r.group) for r in out.collect()} == {(2, "ice_fishing")}
    assert out.columns == ["quarter", "group", "segment", "year", "category", "metric", "value"]


def test_qa_year_change(dash):
    out = D.qa_year_change(dash)
    assert rows(out.select("segment", "year", "threshold", "pct_change")) == [("All", 2000, 20, 30.0)]
    strict = D.qa_year_change(dash, {"participants": {"sex": 10}})
    assert rows(strict.select("category", "pct_change")) == [("Male", pytest.approx(100 / 6))]


def test_qa_scaleup(spark):
    counts = spark.createDataFrame(
        [
            ("p", 2000, "tot", "All", 100, 60), ("p", 2000, "res", "Resident", 60, 60), ("p", 2000, "res", "Nonresident", 30, 0),
            ("p", 2000, "sex", "Male", 70, 50), ("p", 2000, "county", "Adair", 35, 30),
        ],
        "permission string, year int, segment string, category string, n long, n_res long",
    )
    out = D.qa_scaleup(counts, ("permission",))
    assert rows(out.select("segment", "known", "total", "pct_unknown")) == [("county", 30, 60, 50.0), ("sex", 70, 100, 30.0)]


def test_views(dash):
    assert views.month_view(dash).dtypes[4] == ("category", "int")
    assert rows(views.dash_labels(dash).select("metric").distinct()) == [("churn",), ("part",), ("recruits",)]
    assert views.dash_slice(dash, "hunt", 4).count() == 2
    assert views.month_compare(dash, "hunt", 2, 2001).count() == 2
    assert rows(views.county_view(dash, "hunt", 2, 2000).select("category", "value")) == [("Adair", 0.5)]
    grid = views.value_grid(views.dash_slice(dash, "hunt", 2).filter("segment = 'Gender'"), [1999, 2000])
    assert rows(grid) == [("participants", "Female", None, 60.0), ("participants", "Male", 60.0, 70.0)]
    assert rows(views.menu_options(dash)) == [
        ("group", "fish"), ("group", "hunt"), ("quarter", "2"), ("quarter", "4"), ("year", "2000"),
    ]
