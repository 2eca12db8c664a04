"""Versions of the repository's tables: all of a publish or nothing of it, also for runs that are killed."""

import pytest
from pyspark.sql import functions as F
from weftline.repository import store as S

TABLES = {"edges": S.Table("object string, edge long", ["object"]), "usages": S.Table("object string, used string", ["object"]), "registry": S.Table("object string, status string", ["object"])}


class Killed(BaseException):
    """Nothing in the library catches this, as nothing runs after a kill."""


@pytest.fixture
def store(spark, tmp_path):
    s = S.Store(spark, f"file://{tmp_path}/repo", TABLES, 8)
    base = spark.range(60).select(F.concat(F.lit("o"), F.col("id") % 20).alias("object"), F.col("id").alias("edge"))
    s.publish({"edges": S.Replace(base), "usages": S.Replace(base.select("object", F.lit("WHERE").alias("used"))), "registry": S.Replace(base.select("object", F.lit("COMPLETED").alias("status")).distinct())})
    return s


def change(spark):
    """Object o1 gets one edge, o2 none, o99 is new."""
    objects = spark.createDataFrame([("o1",), ("o2",)], "object string")
    return {
        "edges": S.Replace(spark.createDataFrame([("o1", 1000), ("o99", 7)], "object string, edge long"), objects),
        "usages": S.Replace(spark.createDataFrame([("o1", "SELECT")], "object string, used string"), objects),
        "registry": S.Replace(spark.createDataFrame([("o1", "FAILED"), ("o2", "COMPLETED")], "object string, status string"), objects),
    }


def state(store, version=None):
    return {n: sorted(tuple(r) for r in store.read(n, version).collect()) for n in TABLES}


def test_publish_replaces_objects(spark, store):
    old = state(store)
    assert store.publish(change(spark)) == 2
    new = state(store)
    assert [r for r in new["edges"] if r[0] in ("o1", "o2", "o99")] == [("o1", 1000), ("o99", 7)]
    assert [r for r in new["edges"] if r[0] not in ("o1", "o2", "o99")] == [r for r in old["edges"] if r[0] not in ("o1", "o2")]
    assert ("o1", "FAILED") in new["registry"] and len(new["registry"]) == 20
    assert state(store, 1) == old and state(store, 2) == new
    # Buckets of other objects keep their files.
    a, b = store.manifest(1)["tables"]["edges"], store.manifest(2)["tables"]["edges"]
    assert sum(a.get(k) == b[k] for k in b) >= len(b) - 3


@pytest.mark.parametrize("at", ["edges", "usages", "registry", "commit"])
def test_failure_rolls_back(spark, store, at):
    old = state(store)

    def step(what):
        if what == at:
            raise ValueError("disk full")

    with pytest.raises(S.PublishFailed, match="version 2 failed and was rolled back: disk full"):
        store.publish(change(spark), step)
    assert state(store) == old and store.version() == 1
    assert store.vacuum(2, 0) == []  # nothing was left behind
    assert store.publish(change(spark)) == 2


def test_a_failing_task_rolls_back(spark, store):
    old, bad = state(store), change(spark)
    bad["usages"] = S.Replace(bad["usages"].rows.withColumn("used", F.raise_error(F.lit("broken row")).cast("string")), bad["usages"].objects)
    with pytest.raises(S.PublishFailed, match="broken row"):
        store.publish(bad)
    assert state(store) == old and store.vacuum(2, 0) == []


@pytest.mark.parametrize("at", ["edges", "usages", "registry", "commit", "done"])
def test_killed_runs(spark, store, at):
    old = state(store)

    def step(what):
        if what == at:
            raise Killed

    with pytest.raises(Killed):
        store.publish(change(spark), step)
    again = S.Store(spark, store.root, TABLES, 8)  # another process
    if at == "done":  # the rename had made it current
        assert again.version() == 2
        return
    assert state(again) == old
    left = again.vacuum(2, 0)
    assert len(left) == ["edges", "usages", "registry", "commit"].index(at)
    assert state(again) == old and again.publish(change(spark)) == 2


def test_second_of_two_runs_loses(spark, store):
    def other(what):
        if what == "commit":
            S.Store(spark, store.root, TABLES, 8).publish({"edges": S.Replace(spark.createDataFrame([("o1", 5)], "object string, edge long"), spark.createDataFrame([("o1",)], "object string"))})

    with pytest.raises(S.Conflict):
        store.publish(change(spark), other)
    assert [r for r in state(store)["edges"] if r[0] == "o1"] == [("o1", 5)] and ("o1", "COMPLETED") in state(store)["registry"]


def test_restore_and_vacuum(spark, store):
    old = state(store)
    store.publish(change(spark))
    assert store.restore(1) == 3 and state(store) == old
    assert store.vacuum(1) == []  # what a run may be writing stays for a day
    assert len(store.vacuum(1, 0)) == 3 and store.history() == [3] and state(store) == old


def test_empty_store(spark, tmp_path):
    s = S.Store(spark, str(tmp_path / "new"), TABLES)
    assert s.version() == 0 and s.read("edges").columns == ["object", "edge"] and s.read("edges").count() == 0
    s.publish({"edges": S.Replace(s.read("edges"))})
    assert s.version() == 1 and s.read("edges").count() == 0
