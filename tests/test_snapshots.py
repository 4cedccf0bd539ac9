import tempfile

import pytest
from conftest import rows

from fieldbook.sources import loaders as L, writers as W
from fieldbook.sources.snapshots import CommitConflict, Snapshots
from fieldbook.sources.store import FileStore


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="fieldbook-test-")


def history(spark, group, years, n=2):
    return spark.createDataFrame([(group, c, y) for c in range(n) for y in years], "permission string, cust_id long, year int")


def test_tables_change_together_and_readers_see_whole_versions(spark, folder):
    store = Snapshots(spark, folder)
    assert store.version() == 0 and store.manifest() == {}
    first = store.begin()
    first.replace("history", history(spark, "deer", [2000]).unionByName(history(spark, "ice_fishing", [2000])), "permission", ["deer", "ice_fishing"])
    first.replace("permission", spark.createDataFrame([("deer", 1)], "permission string, lic_id long"), "permission", ["deer"])
    assert store.version() == 0  # nothing to be seen before the commit
    assert first.commit() == 1
    change = store.begin()
    change.replace("history", history(spark, "deer", [2000, 2001]), "permission", ["deer"])
    change.replace("permission", spark.createDataFrame([("deer", 1), ("deer", 2)], "permission string, lic_id long"), "permission", ["deer"])
    assert store.table("history").count() == 4 and store.table("permission").count() == 1
    assert change.table("history").count() == 6
    del change  # a writer that dies here leaves the old state
    assert Snapshots(spark, folder).version() == 1 and store.table("history").count() == 4
    again = store.begin()
    again.replace("history", history(spark, "deer", [2000, 2001]), "permission", ["deer"])
    again.commit()
    assert rows(store.table("history").groupBy("permission").count()) == [("deer", 4), ("ice_fishing", 2)]
    assert store.table("history", 1).count() == 4  # the old version is still there


def test_two_writers_cannot_both_commit(spark, folder):
    store = Snapshots(spark, folder)
    one, two = store.begin(), store.begin()
    one.replace("history", history(spark, "deer", [2000]), "permission", ["deer"])
    two.replace("history", history(spark, "deer", [2001]), "permission", ["deer"])
    two.commit()
    with pytest.raises(CommitConflict):
        one.commit()
    assert rows(store.table("history").select("year").distinct()) == [(2001,)] and store.version() == 1
    with pytest.raises(RuntimeError, match="once"):
        two.commit()
    assert [n for n in store.files.names(f"{folder}/versions") if n.endswith(".json")] == ["0000000001.json"]


def test_groups_without_rows_odd_names_and_pruning(spark, folder):
    store = Snapshots(spark, folder)
    odd = ["deer: bow", "a/b=c", "50% off", "ünï"]
    change = store.begin()
    for name in odd:
        change.replace("history", history(spark, name, [2000]), "permission", [name])
    change.commit()
    assert rows(store.table("history").groupBy("permission").count()) == [(n, 2) for n in sorted(odd)]
    change = store.begin()
    change.replace("history", history(spark, "x", []), "permission", ["deer: bow", "new"])
    change.commit()
    assert rows(store.table("history").groupBy("permission").count()) == [(n, 2) for n in sorted(odd[1:])]
    one = store.table("history").where("permission = 'ünï'")
    assert one.count() == 2
    assert "PartitionFilters: [isnotnull(permission" in one._jdf.queryExecution().executedPlan().toString()
    bad = store.begin()
    with pytest.raises(Exception, match="not written"):
        bad.replace("history", history(spark, "stray", [2000]), "permission", ["deer"])
    with pytest.raises(ValueError, match="split by"):
        bad.replace("history", history(spark, "x", [2000]).drop("year"), "permission", ["x"])


def test_vacuum_keeps_what_versions_name(spark, folder):
    store = Snapshots(spark, folder)
    for years in ([2000], [2001], [2002]):
        change = store.begin()
        change.replace("history", history(spark, "deer", years), "permission", ["deer"])
        change.commit()
    lost = store.begin()
    lost.replace("history", history(spark, "deer", [1999]), "permission", ["deer"])  # never committed
    assert len(store.vacuum(keep=2)) == 2
    assert store.versions() == [2, 3] and rows(store.table("history", 2).select("year").distinct()) == [(2001,)]
    assert store.vacuum() != [] and rows(store.table("history").select("year").distinct()) == [(2002,)]


def test_publish_history(spark, folder):
    store = Snapshots(spark, folder)
    lic = spark.createDataFrame([(1, "a"), (2, "b")], "lic_id long, description string")
    hist = history(spark, "x", [2000]).drop("permission")
    W.publish_history(store, hist, "ice fishing", lic)
    W.publish_history(store, hist, "deer", lic.limit(1))
    W.publish_history(store, hist.limit(0), "ice fishing", lic.limit(0))
    assert rows(L.load_history(store, "deer", [2000])) == [(0, 2000), (1, 2000)]
    assert rows(L.load_lic_ids(store, "deer")) == [(1,)] and L.load_lic_ids(store, "ice fishing").count() == 0


def test_file_writer_empties_groups_with_odd_names(spark, folder):
    store = FileStore(spark, folder)
    hist = history(spark, "x", [2000, 2001]).drop("permission")
    for name in ("deer: bow", "50% off", "plain"):
        W.write_history(hist, f"{folder}/history", name)
    for name in ("deer: bow", "50% off"):
        W.write_history(hist.limit(0), f"{folder}/history", name)
    assert rows(store.table("history").groupBy("permission").count()) == [("plain", 4)]
    W.write_history(hist.limit(0), f"{folder}/history", "plain")
    W.write_history(hist, f"{folder}/history", "plain")
    assert store.table("history").count() == 4


def test_file_writer_evaluates_its_input_once(spark, folder):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    hist = history(spark, "deer", [2000]).mapInArrow(count, "permission string, cust_id long, year int")
    W.write_history(hist, f"{folder}/history", groups=["deer"])
    assert seen.value == 2
