"""The documented flow over stored tables, as a user runs it."""

import re
import tempfile

from conftest import rows
from pyspark.sql import functions as F

from fieldbook.operators import history as H, population
from fieldbook.plans.dashboard import dashboard_all
from fieldbook.plans.history import build_history
from fieldbook.sources import loaders, writers
from fieldbook.sources.star_adapter import RULES, YEARS, StarAdapter
from fieldbook.sources.store import FileStore
from fieldbook.workbook.queries import registered, tidy


def test_stored_tables_give_the_registered_dashboard(spark, sf_dir):
    folder = tempfile.mkdtemp(prefix="fieldbook-test-")
    source = StarAdapter(spark, sf_dir).store()
    for name in ("cust", "lic", "sale", "permission", "county_fips", "pop_acs"):
        source.table(name).write.parquet(f"{folder}/{name}")
    store = FileStore(spark, folder)

    cust, lic, sale = loaders.load_license(store, YEARS)
    writers.write_history(build_history(sale, lic, RULES, YEARS, look_ahead=True), f"{folder}/history")
    counties = loaders.load_counties(store, "IA")
    pop = population.prep_pop(loaders.load_pop(store, "IA"), YEARS).join(counties, "county_fips", "left")
    dash = dashboard_all(
        store.table("history"), cust, counties, pop, loaders.load_sale(store, [1999, 2000, 2001]),
        store.table("permission"), RULES, YEARS, quarter=2, select_quarters=(2, 4), dashboard_yrs=[2000, 2001],
    )
    want = registered()["dashboard_all"](spark, sf_dir)
    assert rows(tidy(dash)) == rows(want.select(dash.columns))

    writers.write_dash(dash, f"{folder}/dash")
    back = spark.read.schema(dash.schema).option("header", "true").csv(f"{folder}/dash")
    assert back.count() == dash.count()


def test_bucketed_tables_join_without_exchange(spark, sf_dir):
    star = StarAdapter(spark, sf_dir)
    writers.write_bucketed(build_history(star.sale(), star.lic(), RULES, YEARS, look_ahead=True), "history_b", 4)
    writers.write_bucketed(loaders.load_cust(star.store()), "cust_b", 4)
    setting = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = H.enrich_history(spark.table("history_b"), spark.table("cust_b"))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and not re.search(r"\bExchange\b", plan)
        expanded = H.recode_history(joined).transform(H.expand_quarters, 2, (2, 4), YEARS, ("permission",))
        assert "Exchange" not in expanded._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == spark.table("history_b").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", setting)
        for name in ("history_b", "cust_b"):
            writers.remove_table(spark, name)


def test_fiscal_license_year(spark, sf_dir):
    """A custom month-to-quarter rule gives the step-by-step result."""
    from fieldbook.functions import quarter_by_breaks

    rule, star = quarter_by_breaks(2, 5, 8), StarAdapter(spark, sf_dir)
    base = H.enrich_history(build_history(star.sale(), star.lic(), RULES, YEARS, look_ahead=True), loaders.load_cust(star.store()))
    recoded = H.recode_history(base, rule)
    batch = H.expand_quarters(recoded, 3, (1, 3), YEARS, ("permission",), rule)
    for q in (1, 3):
        steps = H.quarterly_filter(recoded.drop("next_month"), 3, q, YEARS)
        steps = H.quarterly_lapse(steps, q, H.years_at_hand(YEARS, 3, q), ("permission",))
        columns = ["permission", "cust_id", "year", "lapse", "R3"]
        assert rows(batch.filter(F.col("select_quarter") == q).select(columns)) == rows(steps.select(columns))
