"""Several stores on one folder, and what a merge leaves alone."""

import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from starfold.operators.reduce import Years
from starfold.plans import importer
from starfold.plans import store as stores
from starfold.plans.store import Store, StoreConflict

NAMES = ["area_code", "area_label", "item_code", "item_label", "unit", "year", "value"]


def wide(spark, years, unit="t", area="Norland"):
    rows = [(a, f"{area} {a}", i, f"Item {i}", unit, str(y), str(y * 10 + int(i))) for y in years for a in "12" for i in "34"]
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in NAMES))


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_an_older_store_sees_what_others_replaced(spark, store):
    store.replace("data_x", spark.range(5).toDF("a"))
    other = Store(spark, store.root)
    other.replace("data_x", spark.range(100).toDF("a"))
    store.compact("data_x", grace=0)
    store.vacuum(0)
    for s in (store, other.refresh(), Store(spark, store.root)):
        assert s.read("data_x").count() == 100


def test_vacuum_of_an_older_store_deletes_nothing_live(spark, store):
    store.replace("t", spark.range(4).select("id", (F.col("id") % 2).alias("k")), "k")
    other = Store(spark, store.root)
    other.overwrite_partitions("t", spark.range(1).select("id", F.lit(1).cast("long").alias("k")))
    assert store.vacuum(0) != []
    assert rows(Store(spark, store.root).read("t").select("id", "k")) == [(0, 0), (0, 1), (2, 0)]


def test_work_based_on_an_old_state_is_refused(spark, store):
    store.replace("t", spark.range(3).toDF("a"))
    other = Store(spark, store.root)
    with pytest.raises(StoreConflict), store.batch():
        rows_then = store.read("t")
        other.replace("t", spark.range(7).toDF("a"))
        store.replace("t", rows_then.limit(1))
    assert store.read("t").count() == 7 and store.vacuum(0) != []
    assert Store(spark, store.root).read("t").count() == 7


def test_changes_of_different_partitions_and_appends_merge(spark, store):
    k = lambda n, value: spark.range(n).select("id", F.lit(value).alias("dataset_code"))
    other = Store(spark, store.root)
    with store.batch():
        store.replace_rows("dim_a", k(2, "X"), "X", False)
        store.append("log", spark.range(1).toDF("n"))
        other.replace_rows("dim_a", k(3, "Y/1 é"), "Y/1 é", False)  # both create the table
        other.append("log", spark.range(2).toDF("n"))
    found = Store(spark, store.root)
    assert found.read("dim_a").groupBy("dataset_code").count().orderBy("count").collect() == [("X", 2), ("Y/1 é", 3)]
    assert found.read("log").count() == 3
    other.replace_rows("dim_a", k(0, "X"), "X", True)
    assert rows(other.read("dim_a").select("dataset_code").distinct()) == [("Y/1 é",)]
    other.append("log", spark.range(1).toDF("n"))
    before = Store(spark, store.root)
    with before.batch():
        added = before._write("log", before.read("log").coalesce(1), None, False)
        other.append("log", spark.range(5).toDF("n"))  # while the other compacts
        gone = tuple(p.key for p in before._tables["log"].parts)
        before._stage(stores.Change("log", None, before._tables["log"].schema, gone, added[0], schemas=added[1]))
    assert Store(spark, store.root).read("log").count() == 9


def test_many_writers_number_their_entries(spark, store, monkeypatch):
    monkeypatch.setattr(stores, "SNAPSHOT_EVERY", 4)
    store.append("log", spark.range(1).toDF("n"))
    with ThreadPoolExecutor(6) as pool:
        for done in [pool.submit(lambda: Store(spark, store.root).append("log", spark.range(1).toDF("n"))) for _ in range(12)]:
            done.result()
    fresh = Store(spark, store.root)
    assert fresh.read("log").count() == 13 and fresh._number == 13
    assert store.refresh().read("log").count() == 13


def test_a_failing_import_leaves_old_dimensions(spark, store, monkeypatch):
    importer.import_frame(store, wide(spark, [2000]), "CR")
    before = {t: rows(store.read(t)) for t in store.tables()}
    real = Store.replace

    def broken(self, table, *args, **kw):
        if table == "data_cr":
            raise RuntimeError("lost")
        return real(self, table, *args, **kw)

    monkeypatch.setattr(Store, "replace", broken)
    with pytest.raises(RuntimeError, match="lost"):
        importer.import_frame(store, wide(spark, [2001], area="Newland"), "CR")
    for s in (store, Store(spark, store.root)):
        assert {t: rows(s.read(t)) for t in s.tables()} == before
    # Only versions that the log names are left.
    assert store.vacuum(0) == []


def test_a_merge_rewrites_no_old_partition(spark, store):
    """Unit comes back from a constant, and value widens to text; old files stay as they are."""
    importer.import_frame(store, wide(spark, [2000, 2001, 2002]), "CR", years=Years.of(2000, 2001, 2002))
    old = {p.key for p in store._tables["data_cr"].parts if p.value != "2002"}
    later = wide(spark, [2002, 2003], "kg").withColumn("value", F.lit("<0.1"))
    result = importer.import_frame(store, later, "CR", years=Years.of(2002, 2003))
    assert old < {p.key for p in store._tables["data_cr"].parts}
    assert (result.appended_rows, result.row_count) == (8, 16)
    fact = Store(spark, store.root).read("data_cr")
    found = {(r["year"], r["unit"], r["value"]) for r in fact.where("area_code = 1 AND item_code = 3").collect()}
    assert found == {(2000, "t", "20003"), (2001, "t", "20013"), (2002, "kg", "<0.1"), (2003, "kg", "<0.1")}
    assert store.partition_values("data_cr") == ["2000", "2001", "2002", "2003"]
    importer.import_frame(store, wide(spark, [2003]), "CR", years=Years.of(2002, 2003))
    assert store.partition_values("data_cr") == ["2000", "2001", "2003"]
    store.compact("data_cr")
    assert rows(store.read("data_cr").groupBy("year", "unit").count()) == [(2000, "t", 4), (2001, "t", 4), (2003, "t", 4)]


def test_joins_that_a_query_does_not_need_vanish(spark, store):
    importer.import_frame(store, wide(spark, [2000, 2001]), "CR")
    twice = wide(spark, [2000]).union(wide(spark, [2001], area="Other"))
    importer.import_frame(store, twice, "TW")
    importer.register_views(store)
    plan = lambda q: spark.sql(q)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan("SELECT value FROM view_cr_labelled WHERE year = 2000")
    assert plan("SELECT value, area_label FROM view_cr_labelled").count("Join") == 1
    assert plan("SELECT value FROM view_tw_labelled").count("Join") == 1  # keys of dim_area repeat there
    assert Store(spark, store.root).unique_key("dim_area", "CR") == "area_code"
    importer.import_frame(store, twice, "CR")
    assert store.unique_key("dim_area", "CR") is None


def test_entries_are_whole_or_not_there(spark, store):
    store.replace("t", spark.range(1).toDF("a"))
    from starfold.session import create_once, find_paths

    assert create_once(spark, f"{store.root}/table_log/000000000001.json", "other") is False
    assert [json.loads(open(p.replace("file:", "")).read())["changes"][0]["table"] for p in find_paths(spark, f"{store.root}/table_log/0*")] == ["t"]
    assert find_paths(spark, f"{store.root}/table_log/.draft*") == []
