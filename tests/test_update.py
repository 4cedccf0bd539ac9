import random
import tempfile

import pytest
from conftest import rows
from pyspark.sql import functions as F

from fieldbook.operators import history as H
from fieldbook.operators.permissions import PermissionRule
from fieldbook.plans import dashboard as plan, update as U
from fieldbook.plans.history import build_history, permission_sales
from fieldbook.session import delete_folder, fresh_path, stage
from fieldbook.sources import writers as W
from fieldbook.sources.snapshots import Snapshots

RULES = (
    PermissionRule("hunt", "type", ("hunt",)),
    PermissionRule("deer", "priv", ("deer",), parent="hunt"),
    PermissionRule("away", "type", ("hunt",), res_type="Nonresident"),
)
SALE = "cust_id long, lic_id long, year int, month int, res int"


@pytest.fixture(scope="module")
def tables(spark):
    """Sales of eleven years with gaps, long licenses, unknown customers, months on both sides of the year, and repeats."""
    rng = random.Random(8)
    lic = spark.createDataFrame(
        [(1, "one", "hunt", 1, None), (2, "three", "hunt", 3, "deer"), (3, "life", "hunt", 99, None), (4, "fish", "fish", 1, None), (5, "none", "hunt", None, "deer")],
        "lic_id long, description string, type string, duration int, priv string",
    )
    sales = []
    for _ in range(900):
        cust = rng.choice([None, *range(1, 60)])
        sales.append((cust, rng.choice([1, 1, 1, 2, 4, 5, 3 if rng.random() < 0.1 else 1]), rng.randint(2000, 2010), rng.randint(-3, 15), rng.choice([None, 0, 1, 1])))
    sale = stage(spark.createDataFrame(sales + sales[:50], SALE), "sale")
    cust = spark.createDataFrame([(c, rng.choice([1, 2, None]), rng.randint(1930, 2000), rng.choice([19001, 19003, None])) for c in range(1, 60)], "cust_id long, sex int, birth_year int, county_fips int")
    counties = spark.createDataFrame([(19001, "Adair"), (19003, "Adams")], "county_fips int, county string")
    pop = spark.createDataFrame([(19001, y, s, a, 1000.0, "Adair") for y in range(2000, 2012) for s in ("Male", "Female") for a in ("18-24", "25-34")], "county_fips int, year int, sex string, agecat string, pop double, county string")
    return lic, sale, cust, counties, pop


def test_merged_states_equal_the_state_of_all_sales(tables):
    lic, sale, *_ = tables
    yrs = range(2000, 2011)
    perm = permission_sales(sale, lic, RULES, known=False)
    whole = U.season_state(perm, yrs)
    parts = [U.season_state(perm.filter(cut), yrs) for cut in ("year < 2003", "year = 2003 and month < 5", "year = 2003 and month >= 5", "year > 2003")]
    columns = sorted(whole.columns)
    assert rows(U.merge_states(*parts).select(columns)) == rows(whole.select(columns))
    assert rows(U.merge_states(whole, whole).select(columns)) == rows(whole.select(columns))  # told twice changes nothing
    assert rows(U.history_of(whole, yrs, look_ahead=True)) == rows(build_history(sale, lic, RULES, yrs, look_ahead=True))
    months = perm.select("permission", "cust_id", "year", "month").distinct()
    assert rows(U.sale_months_of(whole, yrs)) == rows(months)
    assert rows(U.history_of(whole, yrs, since=2005)) == rows(U.history_of(whole, yrs).filter("year >= 2005"))


def test_months_without_a_bit_are_an_error(spark, tables):
    lic = tables[0]
    far = spark.createDataFrame([(1, 1, 2000, 99, 1)], SALE)
    with pytest.raises(Exception, match="no bit for month"):
        U.season_state(permission_sales(far, lic, RULES, known=False), [2000]).collect()


def full_dashboard(tables, sale, yrs, quarter, shown):
    lic, _, cust, counties, pop = tables
    history = stage(build_history(sale, lic, RULES, yrs, look_ahead=True), "history")
    tagged = W.permission_rows(lic.filter("type = 'hunt'"), "hunt").unionByName(W.permission_rows(lic.filter("priv = 'deer'"), "deer")).unionByName(W.permission_rows(lic.filter("type = 'hunt'"), "away"))
    return plan.dashboard_all(history, cust, counties, pop, sale.filter(F.col("year").isin(*shown)), tagged, RULES, yrs, quarter, (2, 4), shown)


def test_each_update_equals_a_dashboard_from_scratch_without_reading_old_history(spark, tables):
    lic, sale, cust, counties, pop = tables
    store = Snapshots(spark, fresh_path(spark, "store"))
    runs = [(2008, 4, "year <= 2008"), (2009, 1, "year = 2009 and month <= 3"), (2009, 2, "year = 2009 and month between 4 and 6"), (2010, 4, "(year = 2009 and month > 6) or year = 2010")]
    sold = sale.limit(0)
    for last, quarter, cut in runs:
        yrs, new = list(range(2000, last + 1)), sale.filter(cut)
        if store.version():  # rows of years that the update must not look at are taken away
            for part in store.manifest()["history"]["parts"]:
                for year in range(2000, last - 2):
                    delete_folder(spark, f"{store.root}/{part['folder']}/year={year}")
        U.advance(store, new, lic, cust, counties, RULES, yrs, quarter, (2, 4))
        sold = sold.union(new)
        shown = [last - 1, last]
        got = U.dashboard_of_store(store, pop, RULES, shown, shown).withColumn("value", F.round("value", 9))
        want = full_dashboard(tables, stage(sold, "sold"), yrs, quarter, shown).withColumn("value", F.round("value", 9))
        assert rows(got) == rows(want.select(got.columns)), (last, quarter)
    assert store.version() == len(runs)
    again = store.table("counts").count()
    U.advance(store, sale.limit(0), lic, cust, counties, RULES, range(2000, 2011), 4, (2, 4))  # nothing new
    assert store.table("counts").count() == again


def test_dashboard_of_a_store_reads_counts_only(spark, tables):
    lic, sale, cust, counties, pop = tables
    store = Snapshots(spark, fresh_path(spark, "store"))
    U.advance(store, sale, lic, cust, counties, RULES, range(2000, 2011), 4, (2, 4))
    files = U.dashboard_of_store(store, pop, RULES, [2010], [2010]).inputFiles()
    assert {f.split("/data/")[1].split("/")[0] for f in files} == {"counts", "months"}


def test_bucketed_tables_meet_without_exchange(spark, tables):
    lic, sale, cust, *_ = tables
    setting = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        history = build_history(sale, lic, RULES, range(2000, 2011))
        folder = tempfile.mkdtemp(prefix="fieldbook-test-")
        W.write_bucketed(history, "bucketed_history_test", 4, path=f"{folder}/h")
        W.write_bucketed(cust, "bucketed_cust_test", 4, path=f"{folder}/c")
        joined = H.enrich_history(spark.table("bucketed_history_test"), spark.table("bucketed_cust_test"))
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert rows(joined) == rows(H.enrich_history(history, cust).select(joined.columns))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", setting)
        for name in ("history", "cust"):
            W.remove_table(spark, f"bucketed_{name}_test")
