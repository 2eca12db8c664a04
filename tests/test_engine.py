import datetime as dt

import pytest
from pyspark.sql import functions as F
from weftline.functions import analysis, dates
from weftline.operators import relational as R
from weftline.repository import batch, impact, proposals, registry, reports
from weftline.sources import readers
from weftline.streaming import collector


def test_entry_and_names(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_upsert_keeps_changed_until_analysed(spark):
    cols = "object_name string, definition_hash string, previous_definition_hash string, is_changed boolean, is_active boolean, analysis_status string"
    old = spark.createDataFrame([("a", "1", None, True, True, "COMPLETED"), ("b", "1", None, False, True, "COMPLETED"), ("c", "1", None, False, True, "COMPLETED")], cols)
    new = spark.createDataFrame([("a", "1"), ("b", "2"), ("d", "9")], "object_name string, definition_hash string")
    got = {r.object_name: tuple(r)[1:] for r in registry.upsert(old, new, ["object_name"]).collect()}
    assert got == {"a": ("1", None, True, True, "COMPLETED"), "b": ("2", "1", True, True, None), "c": ("1", None, False, True, "COMPLETED"), "d": ("9", None, True, True, None)}


def test_closure_null_columns_and_bound(spark):
    e = spark.createDataFrame([("A", "x", "B", "y", "RESOLVED"), ("b", None, "c", None, "RESOLVED"), ("c", "k", "d", "k", "RESOLVED"), ("q", "q", "r", "r", "UNRESOLVED")], "source string, source_column string, target string, target_column string, resolution_status string")
    got = {(r.origin, r.impacted, r.impact_rank) for r in impact.closure(e).collect()}
    assert got == {("a", "b", 1), ("a", "c", 2), ("a", "d", 3), ("b", "c", 1), ("b", "d", 2), ("c", "d", 1)}
    assert impact.closure(e, 1).agg(F.max("impact_rank")).first()[0] == 1


def test_pivot_unpivot_names(spark):
    d = spark.createDataFrame([(1, "p", 5), (1, "q", 7), (2, "p", 1)], "k int, c string, v int")
    x = R.pivot(d, ["k"], "c", {"p": "pp", "q": "qq"}, {"s": F.sum("v"), "m": F.max("v")})
    assert x.columns == ["k", "s_pp", "m_pp", "s_qq", "m_qq"]
    w = spark.createDataFrame([(1, None, 2)], "k int, a int, b int")
    assert [tuple(r) for r in R.unpivot(w, ["k"], {"a": ["a"], "b": ["b"]}, ["v"], "n").collect()] == [(1, "b", 2)]
    assert R.unpivot(w, ["k"], {"a": ["a"], "b": ["b"]}, ["v"], "n", True).count() == 2


def test_proposals(spark):
    d = spark.createDataFrame([('{"title":"t","body":"b","product_ids":[1,2]}',), ("no json",)], "s string").select(proposals.parse_proposal(F.col("s")).alias("p"))
    assert [tuple(r.p) for r in d.collect()] == [("t", "b", [1, 2]), ("", "no json", [])]
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    assert {tuple(r) for r in proposals.put(rows, spark.createDataFrame([(2, "c"), (3, "d")], rows.schema)).collect()} == {(1, "a"), (2, "c"), (3, "d")}
    assert proposals.next_id(rows).first()[0] == 3


def test_readers(spark, tmp_path):
    for k in ("1", "2"):
        spark.range(2).write.parquet(f"{tmp_path}/ev_{k}.parquet")
    got = {tuple(r) for r in readers.sharded(spark, f"{tmp_path}/ev_*.parquet").collect()}
    assert got == {(0, "1"), (1, "1"), (0, "2"), (1, "2")}
    s = spark.createDataFrame([], "a int, g struct<b:int,c:array<struct<d:string>>>").schema
    assert [x[1] for x in readers.columns_of(s)] == ["a", "g", "g.b", "g.c", "g.c.d"]


def test_render():
    assert reports.render("x __A_B__", {"A_B": "1"}) == "x 1"
    with pytest.raises(ValueError):
        reports.render("__LEFT__", {})


def test_metadata_too_large(spark):
    d = spark.createDataFrame([("p", "d", "v", "VIEW", "SELECT a FROM d.t")], "object_project string, object_dataset string, object_name string, object_type string, definition_text string")
    m = spark.createDataFrame([("p", "d", "t", "a", "a", 1)], "project_id string, dataset_id string, table_name string, column_name string, field_path string, ordinal_position int")
    a = batch.run(d, m)
    assert a.select("failure_stage", "result.status").first() == (None, "COMPLETED")
    assert batch.edges(a).count() == 1
    b = batch.run(d, m, max_metadata=10)
    assert b.select("failure_stage", "result.status").first() == ("METADATA_TOO_LARGE", "PARTIAL_FAILURE")
    assert batch.edges(b).count() == 0 and batch.diagnostics(b).count() == 2


def test_analyzer_for_sql(spark):
    import json

    analysis.register(spark)
    cols = json.dumps([{"table_name": "t", "column_name": "a"}])
    ask = lambda options, sql="SELECT a AS x FROM t", columns=cols: json.loads(spark.sql("SELECT analyze_sql_with(:s, :c, :o, :m) AS r", args={"s": sql, "c": columns, "o": json.dumps(options), "m": '{"by": "me"}'}).first().r)
    assert ask({"impact_target": {"table": "t", "column": "a"}})["impact_status"] == "IMPACT_FOUND"
    none = ask({"impact_target": {"table": "u"}})
    assert none["impact_status"] == "NO_IMPACT" and [d["code"] for d in none["diagnostics"]] == ["IMPACT_NOT_FOUND"] and none["export_metadata"] == {"by": "me"}
    assert ask({"source_discovery_only": True})["source_tables"] == ["t"] and set(ask({"compact_export": True})) == {"status", "outputs", "paths", "diagnostics", "impacts", "export_metadata"}
    with pytest.raises(ValueError):
        analysis.analyze_json("SELECT nosuch FROM t", cols, '{"strict_mode": true}')
    assert spark.sql("SELECT fingerprint_sql('select 1')").first()[0] == "SELECT ?" and json.loads(spark.sql("SELECT analyze_sql('SELECT 1 AS one')").first()[0])["status"] == "COMPLETED"


def test_stream_folds_to_latest(spark, tmp_path):
    rows = [("j1", dt.datetime(2024, 1, 1), "u", "select 1"), ("j2", dt.datetime(2024, 1, 2), "u", "select 2"), ("j2", dt.datetime(2024, 1, 2), "u", "select 2"), ("j3", dt.datetime(2024, 1, 1), "u", "select a from t")]
    spark.createDataFrame(rows, collector.JOB_LOG).write.parquet(f"{tmp_path}/in")
    out = []
    collector.collect(collector.job_stream(spark, f"{tmp_path}/in"), f"{tmp_path}/cp", lambda b, n: out.extend(collector.fold(None, b).collect()))
    assert sorted((r.job_id, r.fingerprint) for r in out) == [("j2", "SELECT ?"), ("j3", "SELECT A FROM T")]


def test_dates(spark):
    days = spark.range(1200).select(F.date_add(F.lit("2022-12-20").cast("date"), F.col("id").cast("int")).alias("d"))
    for begins, code in (("SUNDAY", "%U"), ("MONDAY", "%W")):
        got = days.select("d", dates.week(F.col("d"), begins).alias("w"), dates.trunc_week(F.col("d"), begins).alias("t")).collect()
        assert all(r.w == int(r.d.strftime(code)) and (r.d - r.t).days < 7 and r.t.strftime("%A").upper() == begins for r in got)
    assert spark.sql("SELECT timestamp'2024-06-30 20:00:00' AS t").select(F.dayofyear(dates.at_zone(F.col("t"), "Asia/Tokyo"))).first()[0] == 183


def test_answers_and_listing(spark):
    rows = spark.createDataFrame([(1, "a", "x"), (2, None, "y")], "id int, name string, kind string")
    got = {r.id: r.answer for r in proposals.answers(spark.createDataFrame([(1,), (2,), (7,)], "id int"), rows).collect()}
    assert got == {1: '{"id":1,"name":"a","kind":"x"}', 2: '{"id":2,"kind":"y"}', 7: '{"error":"id=7 is not known"}'}
    assert [r.id for r in proposals.listing(rows, kind="y", name=None).collect()] == [2] and proposals.listing(rows).count() == 2


def test_compare_keeps_repeats(spark):
    c = proposals.compare(F.array(F.lit(1), F.lit(1), F.lit(2)), F.array(F.lit(2), F.lit(3), F.lit(3)))
    assert tuple(spark.range(1).select(*c).first()) == ([3, 3], [1, 1], [2])


def test_strip_create(spark):
    heads = ["CREATE TABLE t AS ", "create or replace table if not exists `a as (b`.t\noptions(description=\"x as select\", a='it\\'s as (') as ", "CREATE TEMP TABLE t -- as select\n/* as ( */ AS"]
    bodies = ["SELECT a AS b FROM t", "(SELECT 1 AS (x))", "WITH q AS (SELECT 1) SELECT * FROM q"]
    rows = [(h + b, b) for h in heads for b in bodies if not (h.endswith("AS") and not b.startswith("("))] + [("SELECT 1 AS (a)", "SELECT 1 AS (a)"), ("CREATE TABLE t (a INT64)", "CREATE TABLE t (a INT64)"), (None, None), ("CREATE TABLE t AS " + "a " * 50_000, "CREATE TABLE t AS " + "a " * 50_000)]
    got = spark.createDataFrame(rows, "q string, want string").select(registry.strip_create(F.col("q")).alias("got"), "want").collect()
    assert all(r.got == r.want for r in got), [(r.got, r.want) for r in got if r.got != r.want]


def test_sample_is_repeatable(spark):
    d = spark.range(20_000).withColumn("k", F.col("id") % 3)
    one, two = ({r.id for r in R.sample(x, ["id"], 10, 4).collect()} for x in (d, d.repartition(7)))
    assert one == two and 1800 < len(one) < 2200 and one != {r.id for r in R.sample(d, ["id"], 10, 5).collect()}


def test_views_that_nobody_opened(spark):
    log = spark.createDataFrame([(dt.datetime(2024, 1, d), "u", f"projects/p/datasets/d/tables/v{v}") for d, v in ((1, 1), (20, 1), (1, 2))], "ts timestamp, user string, v string")
    access = reports.view_access(log, F.array("v"), now=F.lit(dt.datetime(2024, 1, 25)), days=10)
    reg = spark.createDataFrame([("p", "d", f"v{v}", "VIEW", v < 3) for v in (1, 2, 3)], "object_project string, object_dataset string, object_name string, object_type string, is_active boolean")
    assert [(r.view_name, r.query_count, r.days_since) for r in reports.last_access(reg, access, F.lit("2024-01-25").cast("date")).collect()] == [("v1", 1, 5), ("v2", None, None)]
