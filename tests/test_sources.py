"""The catalog as a data source, shards picked by their suffix, scripts and table functions."""

import json
import os

import pytest
from pyspark.sql import functions as F
from weftline.functions import tables
from weftline.repository import daily, script
from weftline.sources import catalog, readers


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("catalog")
    rows = spark.range(3).selectExpr("id", "CAST(id AS DECIMAL(9,2)) AS d", "named_struct('a', 1, 'b', array(named_struct('c', 'x'))) AS g", "timestamp'2024-01-01' AS ts")
    for p, d in (("P", "D1"), ("P", "d2"), ("q", "d1")):
        os.makedirs(at / p / d)
        rows.write.parquet(f"{at}/{p}/{d}/T.parquet")
        (at / p / d / "V.sql").write_text(f"SELECT id, g.a AS first FROM {p}.{d}.T")
        (at / p / d / "blank.sql").write_text(" \n")
    (at / "P" / "D1" / "T.options.json").write_text(json.dumps({"expiration_timestamp": "2030-01-01T00:00:00"}))
    return str(at)


def test_parts(spark, root):
    rows = lambda part: {tuple(r) for r in catalog.read(spark, root, part).collect()}
    assert rows("datasets") == {("p", "d1"), ("p", "d2"), ("q", "d1")}
    assert {(r[0], r[1], r[2]): (r[3], r[4] and r[4].year) for r in rows("tables")}["p", "d1", "t"] == ("BASE TABLE", 2030)
    assert {r[2:4] for r in rows("tables")} == {("t", "BASE TABLE"), ("v", "VIEW"), ("blank", "VIEW")}
    assert {r[2] for r in rows("views")} == {"v"} and len(rows("views")) == 3
    own = [r[3:] for r in sorted(rows("columns"), key=lambda r: r[5]) if r[:2] == ("q", "d1")]
    assert own == [("id", "id", 1, "bigint"), ("d", "d", 2, "decimal(9,2)"), ("g", "g", 3, "struct<a:int,b:array<struct<c:string>>>"), ("g", "g.a", 4, "int"), ("g", "g.b", 5, "array<struct<c:string>>"), ("g", "g.b.c", 6, "string"), ("ts", "ts", 7, "timestamp")]


def test_only_wanted_datasets_are_opened(spark, root):
    c = catalog.read(spark, root, "columns")
    assert c.rdd.getNumPartitions() == 3  # a task for each dataset
    one = c.filter("project_id = 'p' AND dataset_id IN ('d1', 'nosuch')")
    assert one.count() == 7 and one.rdd.getNumPartitions() == 1
    assert c.filter("table_name = 'other'").count() == 0 and c.filter("column_name = 'id'").count() == 3
    os.makedirs(f"{root}/z/broken", exist_ok=True)
    with open(f"{root}/z/broken/bad.parquet", "w") as f:
        f.write("no parquet")
    names = spark.createDataFrame([("p", "d1"), ("q", "d1")], "project_id string, dataset_id string")
    got = catalog.referenced_columns(spark, root, names)
    assert {(r.project_id, r.dataset_id) for r in got.collect()} == {("p", "d1"), ("q", "d1")}
    os.remove(f"{root}/z/broken/bad.parquet")


def test_one_dataset_is_read_without_listing_what_lies_above(spark, root, monkeypatch):
    """Its folder is named as it is; folders above it may be closed to listing, and the name's case is kept."""
    own = os.scandir
    reader = catalog.CatalogReader(root, "columns", "P", "D1")
    monkeypatch.setattr(os, "scandir", lambda at: own(at) if "/P/D1" in str(at) else (_ for _ in ()).throw(PermissionError(at)))
    assert [r[:3] for p in reader.partitions() for r in reader.read(p)][0] == ("p", "d1", "t")
    monkeypatch.undo()
    assert catalog.read(spark, root, "columns", "P", "D1").count() == 7
    with pytest.raises(Exception, match="nosuch"):
        catalog.read(spark, root, "columns", "P", "nosuch").collect()


def test_a_dataset_in_a_store_that_only_spark_reads(spark, root):
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.store.link./in", f"file://{root}")
    rows = lambda at, **more: {tuple(r) for r in catalog.dataset_columns(spark, at).collect()}
    assert rows("viewfs://store/in/P/D1") == rows(f"{root}/P/D1") == rows(f"file://{root}/P/D1/")
    assert {r[:3] for r in rows("viewfs://store/in/P/D1")} == {("p", "d1", "t")}


def test_daily_run_over_a_catalog(spark, root):
    """Columns are read of named datasets alone: the dataset with a broken table is not opened."""
    os.makedirs(f"{root}/q/broken", exist_ok=True)
    with open(f"{root}/q/broken/bad.parquet", "w") as f:
        f.write("no parquet")
    s = daily.run_catalog(spark, root, gate=daily.Gate(include=["^d1$"]))
    assert {(r.target_project, r.target_object, r.target_column, r.source_column) for r in s.edges.collect()} == {(p, "v", c, x) for p in "pq" for c, x in (("id", "id"), ("first", "g.a"))}
    assert s.summary["completed"] == 2
    os.remove(f"{root}/q/broken/bad.parquet")


def test_shards(spark, tmp_path):
    for k, more in (("2023", []), ("2024", []), ("2025", [F.lit(1).alias("n")])):
        spark.range(2).select("id", *more).write.parquet(f"{tmp_path}/ev_{k}.parquet")
    got = {tuple(r) for r in readers.sharded(spark, f"{tmp_path}/ev_*.parquet").select("id", "n", "_TABLE_SUFFIX").collect()}
    assert got == {(i, 1 if k == "2025" else None, k) for i in (0, 1) for k in ("2023", "2024", "2025")}
    some = readers.sharded(spark, f"{tmp_path}/ev_*.parquet", "_TABLE_SUFFIX >= '2024'")
    assert {f.split("/")[-2] for f in some.inputFiles()} == {"ev_2024.parquet", "ev_2025.parquet"}
    assert readers.sharded(spark, f"{tmp_path}/ev_*.parquet", "_TABLE_SUFFIX = 'x'").count() == 0
    assert readers.sharded(spark, f"{tmp_path}/none_*").count() == 0


def test_json_collection(spark, tmp_path):
    (tmp_path / "c.json").write_text('[{"id": 1, "title": "a"},\n {"id": 2}]')
    assert [tuple(r) for r in readers.json_collection(spark, f"{tmp_path}/c.json", "id int, title string").orderBy("id").collect()] == [(1, "a"), (2, None)]


def test_scripts(spark):
    old, new = spark.range(2).withColumn("v", F.lit(1)), spark.range(3).withColumn("v", F.lit(2))
    rows = lambda checks: sorted(tuple(r) for r in script.switch(spark, {1: old, 2: new}, 1, 2, checks).collect())
    assert rows({"v": "v = 2"}) == [(k, 2, "published") for k in range(3)]
    assert rows({"v": "v = 2", "it's": "id < 2"}) == [(k, 1, "rolled back") for k in range(2)]
    # The rows stay with the executors: what comes back is a plan over them, not rows that the driver holds.
    plan = script.switch(spark, {1: old, 2: new}, 1, 2, {"v": "v = 2"})._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" not in plan and "Range" in plan
    spark.range(4).createOrReplaceTempView("four")
    assert tuple(script.each(spark, "four", "id", "SELECT assert_true(:k <> 2, 'it is two')").first()) == (3, 1)


def test_table_functions(spark):
    tables.register(spark)
    rows = [("a", 0), ("a", 50), ("a", 200), ("b", 10), ("a", None), (None, 5)]
    spark.createDataFrame(rows, "key string, s int").select("key", F.timestamp_seconds("s").alias("ts")).createOrReplaceTempView("runs")
    got = spark.sql("SELECT key, session, n FROM sessions(TABLE(runs) PARTITION BY (key) ORDER BY (ts), 60)").collect()
    assert sorted((str(r.key), r.session, r.n) for r in got) == [("None", 1, 1), ("a", 1, 2), ("a", 2, 1), ("b", 1, 1)]
    assert spark.sql("SELECT safe_ratio(1, 0), safe_ratio(1, 2), bucket_of(2500), bucket_of(25, 10)").first()[:] == (None, 0.5, 2, 2)
    assert [tuple(r) for r in spark.sql("SELECT * FROM parts_of('a.b')").collect()] == [(0, "a"), (1, "b")]
