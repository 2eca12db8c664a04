import datetime as dt

import pytest
from pyspark.sql import functions as F
from weftline.repository import batch, daily, impact, jobs, store

VIEW = "object_project string, object_dataset string, object_name string, object_type string, definition_text string"
META = "project_id string, dataset_id string, table_name string, column_name string, field_path string, ordinal_position int"


def views(spark, **texts):
    return spark.createDataFrame([("P", "D", n, "VIEW", t) for n, t in texts.items()], VIEW)


def edges(s):
    return {(r.target_object, r.target_column, r.source_object, r.source_column) for r in s.edges.collect()}


def test_three_runs(spark):
    meta = spark.createDataFrame([("p", "d", "t", c, c, k) for k, c in enumerate("abc")] + [("p", "d", "v1", "x", "x", 1)], META)
    one = daily.run(views(spark, V1="SELECT a AS x FROM d.t WHERE c = 1", V2="SELECT x FROM d.v1", BAD="SELECT nosuch FROM d.t"), meta)
    assert edges(one) == {("v1", "x", "t", "a"), ("v2", "x", "v1", "x")}
    assert {r.object_name: r.analysis_status for r in one.registry.collect()} == {"v1": "COMPLETED", "v2": "COMPLETED", "bad": "FAILED"}
    assert {(r.origin, r.impacted, r.impact_rank) for r in one.impact.collect()} == {("p.d.t", "p.d.v1", 1), ("p.d.v1", "p.d.v2", 1), ("p.d.t", "p.d.v2", 2)}
    assert {r.usage_type for r in one.usages.filter("object_name = 'v1'").collect()} == {"SELECT", "WHERE"}
    assert {r.source_object_type for r in one.edges.filter("target_object = 'v2'").collect()} == {"VIEW"}
    assert [r.object_name for r in one.unanalyzed.collect()] == ["bad"]
    assert one.diagnostics.filter("code = 'PHYSICAL_COLUMN_NOT_FOUND'").count() == 1

    # V1 breaks: its old edge stays; V2 is gone: its edge goes.
    two = daily.run(views(spark, V1="SELECT nope AS x FROM d.t"), meta, one)
    assert edges(two) == {("v1", "x", "t", "a")}
    state = {r.object_name: (r.analysis_status, r.is_active) for r in two.registry.collect()}
    assert state["v1"] == ("FAILED", True) and state["v2"] == ("INACTIVE_OBJECT_NOT_FOUND", False)

    # V1 is mended: its edges are replaced.
    three = daily.run(views(spark, V1="SELECT b AS x FROM d.t"), meta, two)
    assert edges(three) == {("v1", "x", "t", "b")}
    row = three.registry.filter("object_name = 'v1'").first()
    assert (row.analysis_status, row.is_changed) == ("COMPLETED", False)


def test_gate(spark):
    meta = spark.createDataFrame([], META)
    s = daily.run(views(spark, V="SELECT 1 AS one"), meta, gate=daily.Gate(exclude=["^d$"]))
    assert s.registry.count() == 0 and s.impact.count() == 0


def test_sharded_sources(spark):
    """Patterns of one to three parts read the columns of their latest shard in each dataset, not those of older ones."""
    tables = {("d", "e_1"): "ab", ("d", "e_2"): "ac", ("d", "e_10"): "b", ("d", "other"): "a", ("d2", "e_9"): "z"}
    meta = spark.createDataFrame([("p", d, t, c, c, k) for (d, t), cs in tables.items() for k, c in enumerate(cs)], META)
    s = daily.run(views(spark, TWO="SELECT a AS x FROM `d.e_*` WHERE c = 1", THREE="SELECT c FROM `p.d.e_*`", ONE="SELECT z FROM `e_9*`", BOTH="SELECT w.b, o.a FROM `d.e_1*` w JOIN d.other o ON o.a = w.b", OLD="SELECT b FROM `d.e_2*`", NONE="SELECT a FROM `d.f_*`"), meta)
    assert edges(s) == {("two", "x", "e_*", "a"), ("three", "c", "e_*", "c"), ("one", "z", "e_9*", "z"), ("both", "b", "e_1*", "b"), ("both", "a", "other", "a")}
    assert {(r.object_name, r.source_object, r.source_column) for r in s.usages.filter("usage_type = 'WHERE'").collect()} == {("two", "e_*", "c")}
    assert ("p.d.e_*", "p.d.two", 1) in {(r.origin, r.impacted, r.impact_rank) for r in s.impact.collect()}
    # A pattern that no table matches is an absent source: its statement is done, with nothing to publish.
    assert {r.object_name for r in s.unanalyzed.collect()} == {"old"}


LOG = "job_project string, job_id string, parent_job_id string, creation_time timestamp, user_email string, job_type string, state string, error_reason string, statement_type string, query_text string, labels array<struct<key:string,value:string>>, destination_project string, destination_dataset string, destination_table string"


def test_jobs(spark):
    """Tables that jobs make: a lasting one, one per fingerprint, a script's variables, failed jobs; then they stop running."""
    now = dt.datetime.now()
    job = lambda n, who, text, to, kind="CREATE_TABLE_AS_SELECT", parent=None, error=None, days=0, labels=(): ("P", n, parent, now - dt.timedelta(days=days), who, "QUERY", "DONE", error, kind, text, list(labels), "P", "D", to)
    meta = spark.createDataFrame([("p", "d", "t", c, c, k) for k, c in enumerate("abc")], META)
    tables = spark.createDataFrame([("p", "d", "t", None), ("p", "d", "kept", None), ("p", "d", "short", now)], "project_id string, dataset_id string, table_name string, expiration_timestamp timestamp")
    log = spark.createDataFrame([
        job("j1", "dag", "CREATE TABLE d.kept AS SELECT a AS x FROM d.t", "KEPT", days=2), job("j2", "dag", "CREATE OR REPLACE TABLE d.kept AS (SELECT b AS x FROM d.t)", "KEPT"),
        job("s", "dag", "DECLARE Lim, other INT64; -- DECLARE none", None, "SCRIPT"), job("j3", "dag", "SELECT c FROM d.t WHERE c > lim AND a = 1", "short", "SELECT", "s"), job("j4", "dag", "SELECT c FROM d.t WHERE c > lim AND a = 2", "short", "SELECT", "s", days=1),
        job("j5", "person", "SELECT a FROM d.t", "kept", "SELECT"), job("j6", "dag", "SELECT a FROM d.t", "kept", "SELECT", error="x"), job("j7", "plan", "SELECT a AS y FROM d.t", "gone", "SELECT", labels=[("data_source_id", "scheduled_query")]),
    ], LOG)
    accounts = jobs.Accounts(scheduled=["plan"], dags=["dag"])
    one = daily.run(views(spark, V="SELECT x FROM d.kept"), meta, log=log, tables=tables, accounts=accounts)
    assert {r.job_id for r in one.jobs.collect()} == {"j1", "j2", "j3", "j4", "j7"}
    reg = {r.object_name if not r.is_ephemeral else (r.object_dataset, r.source_job_id): r for r in one.registry.collect()}
    assert set(reg) == {"v", "kept", ("dag", "j3"), ("scheduled_query", "j7")}
    assert reg["kept"].definition_text == "(SELECT b AS x FROM d.t)" and reg["kept"].source_job_id == "j2"
    assert reg["dag", "j3"].script_variables == ["lim", "other"] and reg["dag", "j3"].analysis_status == "COMPLETED"
    assert {e for e in edges(one) if not e[0].startswith("fp_")} == {("kept", "x", "t", "b")}
    assert {(e[1], e[3]) for e in edges(one) if e[0].startswith("fp_")} == {("c", "c"), ("y", "a")}

    # Nothing runs any more and the table is gone; the log's window is short once the registry has jobs.
    old = one.jobs.withColumn("creation_time", F.col("creation_time") - F.expr("INTERVAL 30 DAYS"))
    one.jobs = old
    two = daily.run(views(spark, V="SELECT x FROM d.kept"), meta, one, log=log.limit(0), tables=tables.filter("table_name <> 'kept'"), accounts=accounts)
    state = {r.object_name if not r.is_ephemeral else (r.object_dataset, r.source_job_id): (r.is_active, r.analysis_status) for r in two.registry.collect()}
    assert state["kept"] == (False, "INACTIVE_OBJECT_NOT_FOUND") and state["dag", "j3"] == (False, "INACTIVE_FINGERPRINT_NOT_SEEN") and state["v"][0]
    assert edges(two) == set()


def test_metadata_states(spark):
    """A source that is there without columns keeps a statement back; an absent one does not."""
    meta = spark.createDataFrame([("p", "d", "t", "a", "a", 1)], META)
    tables = spark.createDataFrame([("p", "d", "t", None), ("p", "d", "bare", None)], "project_id string, dataset_id string, table_name string, expiration_timestamp timestamp")
    s = daily.run(views(spark, ABSENT="SELECT t.a, g.b FROM d.t t JOIN d.gone g ON g.b = t.a", BARE="SELECT t.a, u.b FROM d.t t JOIN d.bare u ON u.b = t.a", BAD="SELECT FROM ("), meta, tables=tables)
    assert {r.object_name: r.analysis_status for r in s.registry.collect()} == {"absent": "COMPLETED", "bare": "FAILED", "bad": "FAILED"}
    assert edges(s) == {("absent", "a", "t", "a")}
    assert {r.object_name for r in s.diagnostics.collect()} == {"bare", "bad"}


def paths(df):
    return sorted(tuple(map(str, (r.origin, r.origin_column, r.impacted, r.impacted_column, r.path))) for r in df.collect())


def test_narrowed_scan_keeps_what_it_did_not_look_at(spark):
    """A second run over one of two datasets: the other's views, edges, usages and impact stay; so do rows that were out of service."""
    meta = spark.createDataFrame([("p", "d", "t", "a", "a", 1)], META)
    rows = [("p", d, n, "VIEW", "SELECT a FROM d.t WHERE a > 1") for d, n in (("d1", "v1"), ("d1", "v2"), ("d2", "w1"))]
    one = daily.run(spark.createDataFrame(rows, VIEW), meta)
    two = daily.run(spark.createDataFrame(rows[:1], VIEW), meta, one, gate=daily.Gate(include=["^d1$"]))
    state = {r.object_name: (r.is_active, r.is_changed, r.analysis_status) for r in two.registry.collect()}
    assert state == {"v1": (True, False, "COMPLETED"), "v2": (False, False, "INACTIVE_OBJECT_NOT_FOUND"), "w1": (True, False, "COMPLETED")}
    assert {e[0] for e in edges(two)} == {"v1", "w1"} and {r.object_name for r in two.usages.collect()} == {"v1", "w1"}
    assert paths(two.impact) == paths(impact.closure(daily._graph(two.edges)))
    two.registry = two.registry.withColumn("analysis_status", F.when(F.col("object_name") == "v2", "OLD").otherwise(F.col("analysis_status")))
    three = daily.run(spark.createDataFrame(rows[:1], VIEW), meta, two, gate=daily.Gate(include=["^d1$"]))
    assert {r.object_name: r.analysis_status for r in three.registry.collect()}["v2"] == "OLD"
    assert three.summary["definitions"] == 0 and three.moved.count() == 0
    # A name that the gate stops is as good as gone.
    four = daily.run(spark.createDataFrame(rows, VIEW), meta, three, daily.Gate(include=["^d1$"], exclude_objects=["V1"]))
    assert {r.object_name: (r.is_active, r.analysis_status) for r in four.registry.collect()} == {"v1": (False, "INACTIVE_OBJECT_NOT_FOUND"), "v2": (True, "COMPLETED"), "w1": (True, "COMPLETED")}
    assert {e[0] for e in edges(four)} == {"v2", "w1"}


def test_published_runs(spark, tmp_path):
    """Runs published to a store: a failure in any table leaves the last run's tables; the next run goes on from them."""
    meta = spark.createDataFrame([("p", "d", "t", c, c, k) for k, c in enumerate("abc")] + [("p", "d", "v1", "x", "x", 1)], META)
    one = daily.run(views(spark, V1="SELECT a AS x FROM d.t", V2="SELECT x FROM d.v1"), meta)
    assert {k: one.summary[k] for k in ("definitions", "completed", "failed", "paths")} == {"definitions": 2, "completed": 2, "failed": 0, "paths": 2}
    assert one.summary["text_bytes"] == len("SELECT a AS x FROM d.tSELECT x FROM d.v1") and one.summary["written_bytes"] > 0
    at = daily.open_store(spark, f"file://{tmp_path}/store", one)
    assert daily.publish(one, at) == 1
    two = daily.run(views(spark, V1="SELECT b AS x FROM d.t"), meta, daily.load(at))
    for name in ("registry", "edges", "usages", "impact"):

        def step(what, name=name):
            if what == name:
                raise OSError("gone")

        with pytest.raises(store.PublishFailed):
            daily.publish(two, at, step)
    old = daily.load(at)
    assert edges(old) == edges(one) and paths(old.impact) == paths(one.impact)
    assert daily.publish(two, at) == 2
    new = daily.load(at)
    assert edges(new) == edges(two) == {("v1", "x", "t", "b")} and paths(new.impact) == paths(two.impact) == [("p.d.t", "b", "p.d.v1", "x", "['p.d.t.b', 'p.d.v1.x']")]
    assert {r.object_name: r.is_active for r in new.registry.collect()} == {"v1": True, "v2": False}
    three = daily.run(views(spark, V1="SELECT b AS x FROM d.t", V2="SELECT x FROM d.v1"), meta, new)
    assert daily.publish(three, at) == 3 and len(paths(daily.load(at).impact)) == 3


def test_changed_objects_and_a_look(spark):
    meta = spark.createDataFrame([("p", "d", "t", c, c, k) for k, c in enumerate("ab")], META)
    one = daily.run(views(spark, V1="SELECT nosuch FROM d.t", V2="SELECT gone FROM d.t"), meta)
    more = spark.createDataFrame([("p", "d", "t", c, c, k) for k, c in enumerate(["a", "nosuch", "gone"])], META)
    two = daily.analyze_changed(one, more, only=F.col("object_name") == "v1")
    assert edges(two) == {("v1", "nosuch", "t", "nosuch")} and two.summary["definitions"] == 1
    three = daily.analyze_changed(two, more)
    assert {e[0] for e in edges(three)} == {"v1", "v2"} and three.summary["definitions"] == 1
    look = daily.inspect(views(spark, V3="SELECT a, zz FROM d.t"), more)
    s = look["status"].first()
    assert (s.status, s.is_publishable, s.n_outputs) == ("COMPLETED_WITH_ERRORS", False, 2)
    assert {r.code for r in look["diagnostics"].collect()} == {"PHYSICAL_COLUMN_NOT_FOUND"} and [r.column_name.lower() for r in look["paths"].collect()] == ["a"]


def test_each_statement_is_read_once(spark):
    """One Python node finds the sources, one analyses; names meet tables and metadata once."""
    meta = spark.createDataFrame([("p", "d", "t", "a", "a", 1)], META)
    plan = batch.run(views(spark, V="SELECT a FROM d.t"), meta)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.count("Exchange") <= 12
