import glob
import tempfile

import pytest
from conftest import rows
from pyspark.sql import functions as F

from fieldbook import session
from fieldbook.sources import loaders as L, writers as W
from fieldbook.sources.store import CatalogStore, DerivedStore, FileStore, load_table


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="fieldbook-test-")


def test_file_store_formats_and_pushdown(spark, folder):
    sale = spark.createDataFrame([(1, 1, 2000, 1, 1), (2, 1, 2001, 2, 0)], "cust_id long, lic_id long, year int, month int, res int")
    sale.write.parquet(f"{folder}/sale")
    out = L.load_sale(FileStore(spark, folder), [2001, 2002])
    assert rows(out) == [(2, 1, 2001, 2)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(year, [2001,2002])]" in plan and "res:int" not in plan
    sale.write.option("header", True).csv(f"{folder}/csv/sale")
    text = FileStore(spark, f"{folder}/csv", "csv", {"header": "true"})
    assert load_table(text, "sale", lambda t: t.filter("year = 2000")).count() == 1
    bundle = L.load_license(
        DerivedStore({"cust": lambda: sale.select("cust_id"), "lic": lambda: sale.select("lic_id"), "sale": lambda: sale}),
        [2000], ("cust_id", "res"), ("cust_id",),
    )
    assert bundle.sale.columns == ["cust_id", "res"] and bundle.sale.count() == 1 and bundle.cust.count() == 2


def test_catalog_store_and_remove_table(spark):
    spark.createDataFrame([("IA", 19001, "Adair"), ("WI", 55001, "Adams")], "state_abbrev string, county_fips int, county_name string").write.saveAsTable("county_fips")
    assert rows(L.load_counties(CatalogStore(spark), "IA")) == [(19001, "Adair")]
    W.remove_table(spark, "county_fips")
    W.remove_table(spark, "county_fips")
    assert not spark.catalog.tableExists("county_fips")


def history(spark, years):
    return spark.createDataFrame([(c, y, 1) for c in (1, 2) for y in years], "cust_id long, year int, duration_run int")


def test_write_history_replaces_one_permission(spark, folder):
    store = FileStore(spark, folder)
    W.write_history(history(spark, [2000, 2001, 2002]), f"{folder}/history", "ice fishing")
    W.write_history(history(spark, [2000]), f"{folder}/history", "deer")
    W.write_history(history(spark, [2001, 2002]), f"{folder}/history", "ice fishing")
    table = store.table("history")
    assert rows(table.groupBy("permission", "year").count()) == [("deer", 2000, 2), ("ice_fishing", 2001, 2), ("ice_fishing", 2002, 2)]
    out = L.load_history(store, "ice fishing", [2002, 2003])
    assert rows(out.select("cust_id", "year")) == [(1, 2002), (2, 2002)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(permission" in plan and "In(year, [2002,2003])" in plan


def test_write_permission(spark, folder):
    lic = spark.createDataFrame([(1, "a"), (2, "b")], "lic_id long, description string")
    W.write_permission(lic, "deer", f"{folder}/permission")
    W.write_permission(lic, "ice fishing", f"{folder}/permission")
    W.write_permission(lic.filter("lic_id = 2"), "deer", f"{folder}/permission")
    store = FileStore(spark, folder)
    assert rows(L.load_lic_ids(store, "deer")) == [(2,)]
    assert rows(L.load_lic_ids(store, "ice fishing")) == [(1,), (2,)]


def test_rewrite_with_no_rows_leaves_no_rows(spark, folder):
    store, lic = FileStore(spark, folder), spark.createDataFrame([(1, "a")], "lic_id long, description string")
    for group in ("deer", "ice fishing"):
        W.write_history(history(spark, [2000]), f"{folder}/history", group, lic_slct=lic, permission_path=f"{folder}/permission")
    W.write_history(history(spark, []), f"{folder}/history", "ice fishing", lic_slct=lic.limit(0), permission_path=f"{folder}/permission")
    assert rows(store.table("history").groupBy("permission").count()) == [("deer", 2)]
    assert rows(store.table("permission").select("permission", "lic_id")) == [("deer", 1)]
    both = store.table("history").filter("permission = 'none'")
    W.write_history(both, f"{folder}/history", groups=["trout"])
    assert rows(FileStore(spark, folder).table("history").groupBy("permission").count()) == [("deer", 2)]
    with pytest.raises(Exception, match="not written"):
        W.write_history(store.table("history"), f"{folder}/other", groups=["trout"])


def test_empty_dash_group(spark, folder):
    dash = spark.createDataFrame([(q, g, "All", 1.0) for q in (2, 4) for g in ("deer", "hunt")], "quarter int, `group` string, segment string, value double")
    W.write_dash(dash, folder)
    W.write_dash(dash.filter("quarter = 4 and `group` = 'deer'"), folder, groups=["deer"], quarters=[2, 4])
    left = spark.read.option("header", True).csv(folder)
    assert rows(left.select("group", "quarter")) == [("deer", 4), ("hunt", 2), ("hunt", 4)]


def test_upsert_permission(spark):
    lic = spark.createDataFrame([(5, "e")], "lic_id long, description string")
    old = spark.createDataFrame([("deer", 1, "a"), ("deer", 2, "b"), ("trout", 3, "c")], "permission string, lic_id long, description string")
    out = W.upsert_permission(W.permission_rows(lic, "deer"), old)
    assert rows(out) == [("deer", 5, "e"), ("trout", 3, "c")]


def test_write_dash(spark, folder):
    dash = spark.createDataFrame(
        [(2, "hunt", "All", 2000, "All", "rate", 0.5), (4, "hunt", "All", 2000, "All", "rate", None)],
        "quarter int, `group` string, segment string, year int, category string, metric string, value double",
    )
    W.write_dash(dash, folder)
    names = glob.glob(f"{folder}/group=hunt/quarter=2/*.csv")
    assert len(names) == 1 and open(names[0]).read().splitlines() == ["segment,year,category,metric,value", "All,2000,All,rate,0.5"]


def test_stage_and_scratch(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_dir(spark) == shared
    frame = spark.range(5).select(F.col("id"), (F.col("id") * 2).alias("twice"))
    stored = session.stage(frame, "numbers")
    assert rows(stored) == rows(frame)
    assert "ReadSchema: struct<id:bigint>" in stored.select("id")._jdf.queryExecution().executedPlan().toString()
    assert glob.glob(f"{shared}/numbers-*")
    kept, session._given[:] = session._given[:-1], session._given[-1:]
    session.drop_staged(spark)
    session._given[:] = kept
    assert not glob.glob(f"{shared}/numbers-*")
