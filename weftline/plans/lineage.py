"""Queries of the lineage pipeline over definitions, and of its relational parts over the driver's tables."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from weftline.functions import tables
from weftline.functions.analysis import analyze_definitions, explode_result, fingerprint_column, sources_column, tokens_column
from weftline.repository import batch, impact, jobs as job_side, registry, reports, script, store
from weftline.sources import catalog as catalogs, scratch
from weftline.sources.readers import metadata, register_views, sharded, table
from weftline.streaming import collector

QUERIES: dict = {}
SQL: dict[str, str] = {}

#: Definitions over the driver's tables: every construct whose lineage is told apart.
VIEWS = {
    "v_plain": "SELECT c_custkey AS id, c_acctbal * 2 AS twice FROM tpch.customer WHERE c_mktsegment = 'BUILDING'",
    "v_join": "SELECT o.o_orderkey, c.c_name FROM tpch.orders o JOIN tpch.customer c ON o.o_custkey = c.c_custkey",
    "v_cte": "WITH s AS (SELECT l_orderkey AS k, SUM(l_extendedprice * l_discount) AS v FROM tpch.lineitem GROUP BY l_orderkey) SELECT k, v FROM s",
    "v_union": "SELECT n_name AS name FROM tpch.nation UNION ALL SELECT r_name FROM tpch.region",
    "v_star": "SELECT * EXCEPT (r_regionkey) FROM tpch.region",
    "v_window": "SELECT o_orderkey, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS rn FROM tpch.orders QUALIFY rn = 1",
    "v_exists": "SELECT CASE WHEN EXISTS (SELECT 1 FROM tpch.orders o WHERE o.o_custkey = c.c_custkey) THEN c.c_name END AS label FROM tpch.customer c",
    "v_chain": "SELECT id, twice FROM tpch.v_plain",
    "v_const": "SELECT COUNT(*) AS n FROM tpch.region",
    "v_broken": "SELECT nosuch FROM tpch.region",
    "v_bad": "SELECT FROM (",
    "v_pivot": "SELECT * FROM (SELECT o_custkey, o_orderstatus, o_totalprice FROM tpch.orders) PIVOT (SUM(o_totalprice) AS t FOR o_orderstatus IN ('F', 'O' AS open))",
}
#: The views' edges (source, output) as read off the statements by hand.
EDGES = {
    "v_plain": [("customer.c_custkey", "id"), ("customer.c_acctbal", "twice")],
    "v_join": [("orders.o_orderkey", "o_orderkey"), ("customer.c_name", "c_name")],
    "v_cte": [("lineitem.l_orderkey", "k"), ("lineitem.l_extendedprice", "v"), ("lineitem.l_discount", "v")],
    "v_union": [("nation.n_name", "name"), ("region.r_name", "name")],
    "v_star": [("region.r_name", "r_name")],
    "v_window": [("orders.o_orderkey", "o_orderkey"), ("orders.o_custkey", "rn"), ("orders.o_orderdate", "rn")],
    "v_exists": [("customer.c_name", "label"), ("orders.o_custkey", "label"), ("customer.c_custkey", "label")],
    "v_chain": [("v_plain.id", "id"), ("v_plain.twice", "twice")],
    "v_pivot": [("orders.o_custkey", "o_custkey"), ("orders.o_totalprice", "t_f"), ("orders.o_totalprice", "t_open")],
}
STATUS = {v: "COMPLETED" for v in VIEWS} | {"v_broken": "COMPLETED_WITH_ERRORS", "v_bad": "PARTIAL_FAILURE"}


def values(names: str, rows) -> str:
    def lit(v):
        return "NULL" if v is None else str(v).lower() if isinstance(v, bool) else str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"

    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(lit, r)) + ')' for r in rows)}) AS t({names})"


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def definitions(spark: SparkSession) -> DataFrame:
    rows = [("local", "tpch", n, "VIEW", s) for n, s in VIEWS.items()]
    return spark.createDataFrame(rows, "object_project string, object_dataset string, object_name string, object_type string, definition_text string")


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = metadata(spark, {n: table(spark, sf_dir, n) for n in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")})
    views = spark.createDataFrame([("local", "tpch", "v_plain", c, c, k + 1, "string") for k, c in enumerate(("id", "twice"))], base.schema)
    return base.unionByName(views)


def analyzed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch.run(definitions(spark), catalog(spark, sf_dir))


@query(values("target_object, source, target_column", [(v, s, c) for v, e in EDGES.items() for s, c in e]))
def lineage_edges(spark, sf_dir):
    e = batch.edges(analyzed(spark, sf_dir), definitions(spark))
    return e.select("target_object", F.concat_ws(".", "source_object", "source_column").alias("source"), "target_column")


@query(values("object_name, status", list(STATUS.items())))
def lineage_status(spark, sf_dir):
    return analyzed(spark, sf_dir).select("object_name", F.col("result.status").alias("status"))


@query(values("object_name, src, usage_type", [("v_plain", "customer.c_custkey", "SELECT"), ("v_plain", "customer.c_acctbal", "SELECT"), ("v_plain", "customer.c_mktsegment", "WHERE"), ("v_join", "orders.o_orderkey", "SELECT"), ("v_join", "customer.c_name", "SELECT"), ("v_join", "orders.o_custkey", "JOIN_ON"), ("v_join", "customer.c_custkey", "JOIN_ON"), ("v_exists", "customer.c_name", "SELECT"), ("v_exists", "orders.o_custkey", "WHERE"), ("v_exists", "customer.c_custkey", "WHERE"), ("v_cte", "lineitem.l_orderkey", "SELECT"), ("v_cte", "lineitem.l_extendedprice", "SELECT"), ("v_cte", "lineitem.l_discount", "SELECT"), ("v_cte", "lineitem.l_orderkey", "GROUP_BY"), ("v_union", "nation.n_name", "SELECT"), ("v_union", "region.r_name", "SELECT"), ("v_window", "orders.o_orderkey", "SELECT"), ("v_window", "orders.o_custkey", "SELECT"), ("v_window", "orders.o_orderdate", "SELECT"), ("v_chain", "v_plain.id", "SELECT"), ("v_chain", "v_plain.twice", "SELECT"), ("v_pivot", "orders.o_custkey", "SELECT"), ("v_pivot", "orders.o_orderstatus", "SELECT"), ("v_pivot", "orders.o_totalprice", "SELECT")]))
def lineage_usages(spark, sf_dir):
    u = batch.usages(analyzed(spark, sf_dir))
    return u.select("object_name", F.concat_ws(".", "source_object", "source_column").alias("src"), "usage_type")


@query("SELECT o_orderkey, unnest(['d.t' || o_custkey % 50, 'p.d.u' || lower(o_orderstatus), 'w' || left(o_orderpriority, 1)]) AS source FROM orders")
def source_discovery(spark, sf_dir):
    """The tables that a statement made of each order reads."""
    o = table(spark, sf_dir, "orders")
    text = F.concat(F.lit("WITH q AS (SELECT a FROM d.T"), F.col("o_custkey") % 50, F.lit(") SELECT q.a FROM q JOIN `p.d.u"), "o_orderstatus", F.lit("` u USING (k) WHERE u.x IN (SELECT y FROM w"), F.left("o_orderpriority", F.lit(1)), F.lit(" -- FROM none\n)"))
    return o.select("o_orderkey", text.alias("q")).select("o_orderkey", F.explode(sources_column("q")).alias("source"))


@query(values("object_name, code", [("v_broken", "PHYSICAL_COLUMN_NOT_FOUND"), ("v_broken", "UDF_RESULT_NOT_PUBLISHABLE"), ("v_bad", "ANALYSIS_EXECUTION_FAILED"), ("v_bad", "UDF_RESULT_NOT_PUBLISHABLE")]))
def lineage_diagnostics(spark, sf_dir):
    return batch.diagnostics(analyzed(spark, sf_dir)).select("object_name", "code")


@query(values("object_name, output", [("v_exists", "LABEL"), ("v_join", "C_NAME")]))
def query_impact(spark, sf_dir):
    d = batch.with_sources(definitions(spark), catalog(spark, sf_dir))
    return analyze_definitions(d, target={"table": "tpch.customer", "column": "c_name"}).select("object_name", F.explode("result.impacts").alias("output"))


@query(values("object_name, scopes, kinds", [("v_cte", 2, "CTE_QUERY,ROOT_QUERY"), ("v_exists", 2, "EXPRESSION_SUBQUERY,ROOT_QUERY"), ("v_union", 2, "ROOT_QUERY,SET_OPERATION_QUERY"), ("v_pivot", 2, "ROOT_QUERY,SUBQUERY"), *[(v, 1, "ROOT_QUERY") for v in ("v_plain", "v_join", "v_star", "v_window", "v_chain", "v_const", "v_broken")]]))
def query_scopes(spark, sf_dir):
    s = explode_result(analyzed(spark, sf_dir), "scopes")
    return s.groupBy("object_name").agg(F.count(F.lit(1)).cast("int").alias("scopes"), F.array_join(F.array_sort(F.collect_set("kind")), ",").alias("kinds"))


@query("SELECT o_orderkey, 'SELECT A FROM T WHERE K = ? AND S = ? LIMIT ?' AS fp, sha256('SELECT A FROM T WHERE K = ? AND S = ? LIMIT ?') AS h FROM orders")
def fingerprint_groups(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    sql = F.concat(F.lit("select a -- c\n from t where k = "), F.col("o_orderkey"), F.lit(" and s = '"), F.col("o_orderstatus"), F.lit("' limit "), F.col("o_custkey"))
    return o.select("o_orderkey", sql.alias("q")).withColumn("fp", fingerprint_column("q")).select("o_orderkey", "fp", F.sha2("fp", 256).alias("h"))


@query("SELECT o_orderkey, 10 AS n, 'KEYWORD,IDENTIFIER,OPERATOR,NUMBER,KEYWORD,IDENTIFIER,KEYWORD,IDENTIFIER,OPERATOR,STRING' AS kinds FROM orders")
def tokens(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    sql = F.concat(F.lit("SELECT a + "), F.col("o_orderkey"), F.lit(" FROM t WHERE s = '"), F.col("o_orderstatus"), F.lit("'"))
    x = o.select("o_orderkey", sql.alias("q")).withColumn("t", tokens_column("q"))
    return x.select("o_orderkey", F.size("t").alias("n"), F.array_join(F.transform("t", lambda v: v["kind"]), ",").alias("kinds"))


def _geo(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.concat(F.lit("n"), F.col("n_nationkey")).alias("source"), F.lit("k").alias("source_column"), F.concat(F.lit("r"), F.col("n_regionkey")).alias("target"), F.lit("k").alias("target_column"))
    s = table(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), F.col("s_suppkey")).alias("source"), F.lit("k").alias("source_column"), F.concat(F.lit("n"), F.col("s_nationkey")).alias("target"), F.lit("k").alias("target_column"))
    r = table(spark, sf_dir, "region").select(F.concat(F.lit("r"), F.col("r_regionkey")).alias("source"), F.lit(None).cast("string").alias("source_column"), F.lit("world").alias("target"), F.lit(None).cast("string").alias("target_column"))
    return s.unionByName(n).unionByName(r).withColumn("resolution_status", F.lit("RESOLVED"))


GEO = """e AS (SELECT 's' || s_suppkey AS s, 'k' AS sc, 'n' || s_nationkey AS t, 'k' AS tc FROM supplier UNION SELECT 'n' || n_nationkey, 'k', 'r' || n_regionkey, 'k' FROM nation UNION SELECT 'r' || r_regionkey, NULL, 'world', NULL FROM region),
c AS (SELECT s AS origin, sc AS oc, 1 AS impact_rank, t AS impacted, tc AS ic, [s || '.' || coalesce(sc, '*'), t || '.' || coalesce(tc, '*')] AS p, false AS cyc FROM e
      UNION ALL SELECT c.origin, c.oc, c.impact_rank + 1, e.t, e.tc, list_append(c.p, e.t || '.' || coalesce(e.tc, '*')), list_contains(c.p, e.t || '.' || coalesce(e.tc, '*')) FROM c JOIN e ON e.s = c.impacted AND (e.sc = c.ic OR e.sc IS NULL OR c.ic IS NULL) WHERE NOT c.cyc AND c.impact_rank < 10)"""


@query(f"WITH RECURSIVE {GEO} SELECT DISTINCT origin, impact_rank, impacted, array_to_string(p, ' -> ') AS path, sha256(array_to_string(p, ' -> ')) AS path_hash, cyc AS is_cycle FROM c")
def impact_closure(spark, sf_dir):
    c = impact.closure(_geo(spark, sf_dir), 10)
    return c.select("origin", "impact_rank", "impacted", F.array_join("path", " -> ").alias("path"), "path_hash", "is_cycle")


MOVED_GEO = GEO.replace("'n' || s_nationkey AS t", "'n' || (s_nationkey + CASE WHEN s_suppkey % 5 = 0 THEN 7 ELSE 0 END) % 25 AS t").replace("'r' || n_regionkey, 'k' FROM nation", "'r' || n_regionkey, 'k' FROM nation WHERE n_nationkey % 4 <> 1 UNION SELECT 'n' || n_nationkey, NULL, 'r' || (n_regionkey + 1) % 5, NULL FROM nation WHERE n_nationkey % 6 = 0")


@query(f"WITH RECURSIVE {MOVED_GEO} SELECT DISTINCT origin, oc AS origin_column, impact_rank, impacted, ic AS impacted_column, array_to_string(p, ' -> ') AS path, cyc AS is_cycle FROM c")
def impact_delta(spark, sf_dir):
    """The closure after suppliers moved and nations lost or gained edges, from the closure before and the changed edges alone."""
    before, s, n = _geo(spark, sf_dir), table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    left = before.join(s.filter("s_suppkey % 5 = 0").select(F.concat(F.lit("s"), "s_suppkey").alias("source")).union(n.filter("n_nationkey % 4 = 1").select(F.concat(F.lit("n"), "n_nationkey"))), "source", "left_anti")
    none = F.lit(None).cast("string")
    moved = s.filter("s_suppkey % 5 = 0").select(F.concat(F.lit("s"), "s_suppkey").alias("source"), F.lit("k").alias("source_column"), F.concat(F.lit("n"), (F.col("s_nationkey") + 7) % 25).alias("target"), F.lit("k").alias("target_column"), F.lit("RESOLVED").alias("resolution_status"))
    wide = n.filter("n_nationkey % 6 = 0").select(F.concat(F.lit("n"), "n_nationkey").alias("source"), none.alias("source_column"), F.concat(F.lit("r"), (F.col("n_regionkey") + 1) % 5).alias("target"), none.alias("target_column"), F.lit("RESOLVED").alias("resolution_status"))
    after = left.unionByName(moved).unionByName(wide)
    closure, _ = impact.maintain(impact.closure(before, 10), before, after, 10)
    return closure.select("origin", "origin_column", "impact_rank", "impacted", "impacted_column", F.array_join("path", " -> ").alias("path"), "is_cycle")


@query("""WITH RECURSIVE x AS (SELECT DISTINCT n_regionkey AS a, (n_regionkey * 2 + 1) % 5 AS b FROM nation), c AS (SELECT a AS origin, 1 AS rk, b AS cur, [a::VARCHAR || '.*', b::VARCHAR || '.*'] AS p, false AS cyc FROM x
UNION ALL SELECT c.origin, c.rk + 1, x.b, list_append(c.p, x.b::VARCHAR || '.*'), list_contains(c.p, x.b::VARCHAR || '.*') FROM c JOIN x ON x.a = c.cur WHERE NOT c.cyc AND rk < 9)
SELECT DISTINCT origin::VARCHAR AS origin, rk AS impact_rank, array_to_string(p, ' -> ') AS path FROM c WHERE cyc""")
def impact_cycle(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select("n_regionkey").distinct()
    none = F.lit(None).cast("string")
    e = n.select(F.col("n_regionkey").cast("string").alias("source"), none.alias("source_column"), ((F.col("n_regionkey") * 2 + 1) % 5).cast("string").alias("target"), none.alias("target_column"), F.lit("RESOLVED").alias("resolution_status"))
    return impact.closure(e, 9).filter("is_cycle").select("origin", "impact_rank", F.array_join("path", " -> ").alias("path"))


@query(f"WITH RECURSIVE {GEO}, u AS (SELECT DISTINCT 'n' || c_nationkey AS s, 'k' AS k, 'q' || c_mktsegment AS o, CASE WHEN c_acctbal > 0 THEN 'WHERE' ELSE 'SELECT' END AS ut FROM customer) SELECT origin, object, usage_type, depth FROM (SELECT s AS origin, o AS object, ut AS usage_type, 1 AS depth FROM u UNION ALL SELECT c.origin, lower(u.o), ut, c.impact_rank + 1 FROM (SELECT DISTINCT origin, impacted, ic, impact_rank, p FROM c) c JOIN u ON u.s = c.impacted AND u.k = c.ic)".replace("lower(u.o)", "u.o"))
def usage_depth_union(spark, sf_dir):
    u = table(spark, sf_dir, "customer").select(F.concat(F.lit("n"), F.col("c_nationkey")).alias("source"), F.lit("k").alias("source_column"), F.concat(F.lit("q"), F.col("c_mktsegment")).alias("object"), F.when(F.col("c_acctbal") > 0, "WHERE").otherwise("SELECT").alias("usage_type")).distinct()
    return impact.usage_impact(u, impact.closure(_geo(spark, sf_dir), 10)).select("origin", "object", "usage_type", "depth")


@query(f"WITH RECURSIVE {GEO} SELECT DISTINCT origin, impact_rank, impacted, CASE WHEN impacted[1] = 'n' THEN 'ROW_DEPENDENCY' WHEN impacted[1] = 'r' THEN 'VALUE_DEPENDENCY' ELSE 'UNKNOWN' END AS impact_type, array_to_string(p, ' → ') AS path FROM c WHERE origin = 's1'")
def impact_report(spark, sf_dir):
    e = _geo(spark, sf_dir)
    typed = e.withColumn("usage_type", F.when(F.col("target").startswith("n"), "WHERE").when(F.col("target").startswith("r"), "SELECT").otherwise("OTHER"))
    return impact.report(impact.closure(e, 10), typed, "S1").select("origin", "impact_rank", "impacted", "impact_type", "path")


@query("""SELECT o_orderkey AS object_name, CASE WHEN o_custkey % 4 = 0 THEN 'NOT_ANALYZED' WHEN o_custkey % 4 = 1 THEN 'DEFINITION_CHANGED' ELSE 'FAILED' END AS coverage_reason
FROM orders WHERE o_custkey % 4 < 3 AND o_orderstatus <> 'P'""")
def coverage_reason(spark, sf_dir):
    o, r = table(spark, sf_dir, "orders"), F.col("o_custkey") % 4
    h = F.sha2(F.col("o_orderkey").cast("string"), 256)
    reg = o.select(F.col("o_orderkey").alias("object_name"), h.alias("definition_hash"), F.when(r == 1, "old").otherwise(h).alias("last_analyzed_hash"), F.when(r == 0, None).when(r == 2, "FAILED").otherwise("COMPLETED").alias("analysis_status"), F.lit(True).alias("is_active"), (F.col("o_orderstatus") == "P").alias("is_ephemeral"), F.col("o_orderdate").alias("last_seen_at"))
    return reports.unanalyzed(reg).select("object_name", "coverage_reason")


@query("SELECT 'p' AS project, event_type AS dataset, 'v' || (user_id % 7) AS view_name, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_accessed_at, count(*) AS query_count, count(DISTINCT user_id) AS distinct_users, arg_max(user_id, (ts, user_id)) AS latest_user FROM events GROUP BY ALL")
def last_access(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("ts", F.col("user_id").alias("user"), F.concat(F.lit("projects/p/datasets/"), F.col("event_type"), F.lit("/tables/v"), F.col("user_id") % 7).alias("v"))
    return reports.view_access(e, F.array("v")).withColumn("last_accessed_at", F.date_format("last_accessed_at", "yyyy-MM-dd HH:mm:ss"))


#: Heads of CREATE TABLE ... AS with a body each, and a statement without a head.
HEADS = [
    ("create or replace table x.y as ", "SELECT {k}"), ("CREATE TABLE `p.d.t` PARTITION BY d CLUSTER BY a, b AS ", "(SELECT {k})"),
    ("CREATE TABLE IF NOT EXISTS d.t options(description='made as (a)', labels=[(\"as\", \"with select\")]) AS ", "WITH q AS (SELECT {k} AS n) SELECT n AS (m FROM q"),
    ("CREATE TEMP TABLE t -- as (select\n AS ", "SELECT {k} AS as_select"), ("CREATE TABLE `as (b` /* as select */ AS\n", "SELECT a FROM (SELECT {k} AS a)"), ("", "SELECT {k} AS (x"),
]


def _text(x: str) -> str:
    return "'" + x.replace("'", "''").replace("{k}", "' || o_orderkey || '") + "'"


@query(f"SELECT o_orderkey, CASE o_custkey % 6 {' '.join(f'WHEN {n} THEN {_text(body)}' for n, (_, body) in enumerate(HEADS))} END AS q FROM orders")
def ctas_strip(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    whole = F.lit(None).cast("string")
    for n, (head, body) in enumerate(HEADS):
        whole = F.when(F.col("o_custkey") % 6 == n, F.replace(F.lit(head + body), F.lit("{k}"), F.col("o_orderkey").cast("string"))).otherwise(whole)
    return o.select("o_orderkey", registry.strip_create(whole).alias("q"))


@query("""WITH d AS (SELECT DISTINCT strftime(ts, '%Y%m%d') AS d FROM events)
SELECT 'ev.events_' || left(d, 6) || '*' AS name, 'events_' || max(d) AS table_name FROM d GROUP BY left(d, 6) UNION ALL SELECT 'p.ev.events_' || d, 'events_' || d FROM d UNION ALL SELECT 'ev.(x|events_*', NULL FROM d WHERE false""")
def exact_or_shard_match(spark, sf_dir):
    """Each month's pattern stands for the latest of its daily tables; full names for themselves; regex signs in a name for nothing else."""
    days = table(spark, sf_dir, "events").select(F.date_format("ts", "yyyyMMdd").alias("d")).distinct()
    known = days.select(F.lit("P").alias("project_id"), F.lit("ev").alias("dataset_id"), F.concat(F.lit("events_"), "d").alias("table_name"), F.lit(True).alias("collected"))
    names = days.select(F.concat(F.lit("ev.events_"), F.left("d", F.lit(6)), F.lit("*")).alias("name")).union(days.select(F.concat(F.lit("p.ev.events_"), "d"))).union(days.select(F.lit("ev.(x|events_*")))
    return batch.match_names(names, known).select("name", "table_name")


@query(values("definitions, completed, with_errors, failed", [(12, 10, 1, 1)]))
def run_summary(spark, sf_dir):
    return reports.run_summary(analyzed(spark, sf_dir)).select(*[F.col(c).cast("int").alias(c) for c in ("definitions", "completed", "with_errors", "failed")])


@query("SELECT 'orders_without_customer' AS \"check\", count(*) AS violations, CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) UNION ALL SELECT 'overall', count(*), CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)")
def validation(spark, sf_dir):
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return reports.validate({"orders_without_customer": o.join(c, o.o_custkey == c.c_custkey, "left_anti")})


@query(values("kept", [("v_plain->v_keep",), *[(f"{v}->{v}",) for v in EDGES]]))
def publish_keeps_failed(spark, sf_dir):
    """Old edges of a failed definition stay; those of an analysed one are replaced."""
    a = analyzed(spark, sf_dir)
    schema = "target_project string, target_dataset string, target_object string, source_object string"
    old = spark.createDataFrame([("local", "tpch", "v_broken", "v_plain"), ("local", "tpch", "v_cte", "old")], schema)
    new = batch.edges(a).select("target_project", "target_dataset", "target_object", F.col("target_object").alias("source_object")).distinct()
    out = batch.publish(old, new, a)
    return out.select(F.concat("source_object", F.lit("->"), F.when(F.col("target_object") == "v_broken", "v_keep").otherwise(F.col("target_object"))).alias("kept"))


PUBLISHED = {"edges": store.Table("object string, edge long, cents long", ["object"]), "usages": store.Table("object string, used string", ["object"])}


@query("""SELECT 'edges' AS tab, 't' || o_custkey % 200 AS object, o_orderkey AS edge, round(o_totalprice * 100)::BIGINT AS cents, NULL AS used FROM orders WHERE CASE WHEN o_custkey % 200 % 3 = 0 THEN o_orderstatus = 'O' ELSE o_orderstatus = 'F' END
UNION ALL SELECT DISTINCT 'usages', 't' || o_custkey % 200, NULL::BIGINT, NULL::BIGINT, o_orderpriority FROM orders WHERE CASE WHEN o_custkey % 200 % 3 = 0 THEN o_orderstatus = 'O' ELSE o_orderstatus = 'F' END""")
def publish_versions(spark, sf_dir):
    """Two tables published in versions: all objects, then some replaced in both, then a run that fails in its second table."""
    at = store.Store(spark, scratch.folder(spark, "store"), PUBLISHED)
    o = table(spark, sf_dir, "orders").select(F.concat(F.lit("t"), F.col("o_custkey") % 200).alias("object"), F.col("o_orderkey").alias("edge"), F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"), F.col("o_orderpriority").alias("used"), "o_orderstatus", (F.col("o_custkey") % 200).alias("n"))
    edges, usages = lambda x: x.select("object", "edge", "cents"), lambda x: x.select("object", "used").distinct()
    old, third = o.filter("o_orderstatus = 'F'"), o.filter("n % 3 = 0").select("object").distinct()
    at.publish({"edges": store.Replace(edges(old)), "usages": store.Replace(usages(old))})
    new = o.filter("o_orderstatus = 'O' AND n % 3 = 0")
    at.publish({"edges": store.Replace(edges(new), third), "usages": store.Replace(usages(new), third)})

    def full(what):
        if what == "usages":
            raise OSError("no space left")

    try:
        at.publish({"edges": store.Replace(edges(o.filter("o_orderstatus = 'P'")), o.select("object").distinct()), "usages": store.Replace(usages(o))}, full)
    except store.PublishFailed:
        pass  # readers stay on the second version
    none = lambda t: F.lit(None).cast(t)
    return at.read("edges").select(F.lit("edges").alias("tab"), "object", "edge", "cents", none("string").alias("used")).unionByName(at.read("usages").select(F.lit("usages").alias("tab"), "object", none("long").alias("edge"), none("long").alias("cents"), "used"))


DEFINITION = "object_project string, object_dataset string, object_name string, object_type string, definition_text string"
META = "project_id string, dataset_id string, table_name string, column_name string, field_path string, ordinal_position int"
#: Sources that are there with columns (have), there without (bare), sharded (e_1, e_2) and absent.
STATES = {
    "whole": "SELECT a FROM d.have WHERE a > {k}", "absent": "SELECT h.a, g.x FROM d.have h JOIN d.gone g ON g.x = h.a + {k}", "uncollected": "SELECT h.a, b.x FROM d.have h JOIN d.bare b ON b.x = h.a - {k}",
    "shards": "SELECT c FROM `d.e_*` LIMIT {k}", "unreadable": "SELECT {k} FROM (", "large": "SELECT a, b FROM d.wide WHERE a < {k}",
}


#: Bytes of the metadata of ``wide`` as JSON, and of each state's text without its number.
WIDE_COLUMNS = [("have", "a"), ("e_1", "a"), ("e_2", "c"), *[("wide", c) for c in ("a", "b", *[f"column_{k}" for k in range(50)])]]
WIDE_BYTES = len(json.dumps([{"project_id": "p", "dataset_id": "d", "table_name": t, "column_name": c, "field_path": c, "ordinal_position": k} for k, (t, c) in enumerate(WIDE_COLUMNS) if t == "wide"], separators=(",", ":")))
STATE_BYTES = " ".join(f"WHEN {n} THEN {len(x) - 3}" for n, x in enumerate(STATES.values()))


def _states(spark, sf_dir, max_metadata: int = batch.MAX_METADATA):
    """A view for each order, in one of six states."""
    meta = spark.createDataFrame([("p", "d", t, c, c, k) for k, (t, c) in enumerate(WIDE_COLUMNS)], META)
    there = meta.select("project_id", "dataset_id", "table_name").distinct().union(spark.createDataFrame([("p", "d", "bare")], "a string, b string, c string"))
    text = F.lit(None).cast("string")
    for n, x in enumerate(STATES.values()):
        text = F.when(F.col("o_custkey") % 6 == n, F.replace(F.lit(x), F.lit("{k}"), F.col("o_orderkey").cast("string"))).otherwise(text)
    texts = table(spark, sf_dir, "orders").select(F.lit("p").alias("object_project"), F.lit("d").alias("object_dataset"), F.concat(F.lit("v"), "o_orderkey").alias("object_name"), F.lit("VIEW").alias("object_type"), text.alias("definition_text"))
    return batch.run(texts, meta, tables=there, max_metadata=max_metadata)


def _by_state(select: str, **cases) -> str:
    """SQL over orders with a value for each state."""
    lit = lambda v: "NULL" if v is None else str(v).lower() if isinstance(v, bool) else f"'{v}'"
    pick = ", ".join(f"CASE o_custkey % 6 {' '.join(f'WHEN {n} THEN {lit(v)}' for n, v in enumerate(vs))} END AS {name}" for name, vs in cases.items())
    return f"SELECT {select}, {pick} FROM orders"


@query(_by_state("'v' || o_orderkey AS object_name", absent=[False, True, False, False, None, False], uncollected=[False, False, True, False, None, False], is_published=[True, True, False, True, False, True]))
def publishability(spark, sf_dir):
    a = _states(spark, sf_dir)
    return a.select("object_name", F.col("has_absent_source").alias("absent"), F.col("has_uncollected_source").alias("uncollected"), batch.publishable(a).alias("is_published"))


@query(_by_state("'v' || o_orderkey AS object_name", failure_stage=[None, None, None, None, "SOURCE_DISCOVERY", "METADATA_TOO_LARGE"], status=["COMPLETED", "COMPLETED_WITH_WARNINGS", "COMPLETED_WITH_WARNINGS", "COMPLETED", "PARTIAL_FAILURE", "PARTIAL_FAILURE"]))
def metadata_guard(spark, sf_dir):
    return _states(spark, sf_dir, 1000).select("object_name", "failure_stage", F.col("result.status").alias("status"))


@query("SELECT 'v' || o_orderkey AS target_object, unnest(CASE o_custkey % 6 WHEN 0 THEN ['have.a'] WHEN 1 THEN ['have.a'] WHEN 3 THEN ['e_*.c'] WHEN 5 THEN ['wide.a', 'wide.b'] ELSE [] END) AS source FROM orders")
def batch_sharded(spark, sf_dir):
    return batch.edges(_states(spark, sf_dir)).select("target_object", F.concat_ws(".", "source_object", "source_column").alias("source"))


@query(f"""SELECT 'v' || o_orderkey AS object_name, CASE o_custkey % 6 WHEN 2 THEN 'status COMPLETED_WITH_WARNINGS' WHEN 4 THEN 'the sources of p.d.v' || o_orderkey || ' cannot be told'
ELSE 'p.d.v' || o_orderkey || ' reads tables with {WIDE_BYTES} bytes of column metadata, more than a statement may have' END AS message FROM orders WHERE o_custkey % 6 IN (2, 4, 5)""")
def failure_messages(spark, sf_dir):
    """Why definitions are not published, worst first."""
    return reports.non_completed(_states(spark, sf_dir, 1000)).filter("code = 'UDF_RESULT_NOT_PUBLISHABLE'").select("object_name", "message")


@query(f"""SELECT count(*) AS definitions, count(*) FILTER (WHERE o_custkey % 6 IN (0, 3, 5)) AS completed, count(*) FILTER (WHERE o_custkey % 6 IN (1, 2)) AS with_warnings, 0::BIGINT AS with_errors, count(*) FILTER (WHERE o_custkey % 6 = 4) AS failed,
sum(CASE o_custkey % 6 {STATE_BYTES} END + length(o_orderkey::VARCHAR))::BIGINT AS text_bytes FROM orders""")
def batch_counters(spark, sf_dir):
    """A run's counters, observed while its results are written and not read again for it."""
    _, seen = reports.counted(_states(spark, sf_dir))
    names = ["definitions", "completed", "with_warnings", "with_errors", "failed", "text_bytes"]
    return spark.createDataFrame([tuple(seen[n] for n in names)], ", ".join(f"{n} long" for n in names))


@query("""SELECT 'v' || o_orderkey AS target_object, unnest([{'s': 'orders.o_orderkey', 'c': 'id'}, {'s': 'lineitem.l_quantity', 'c': 'amount'}, {'s': CASE WHEN o_custkey % 3 = 0 THEN 'lineitem.l_tax' ELSE 'lineitem.l_discount' END, 'c': 'amount'}, {'s': 'orders.o_totalprice', 'c': 'p' || o_custkey % 7}]) AS e FROM orders""".join(["SELECT target_object, e.s AS source, e.c AS target_column FROM (", ")"]))
def lineage_estate(spark, sf_dir):
    """Edges of a definition made of each order: a CTE with an aggregate, a join, behind CREATE TABLE ... AS for every other one."""
    o = table(spark, sf_dir, "orders")
    text = F.concat(
        F.when(F.col("o_orderkey") % 2 == 0, "CREATE OR REPLACE TABLE d.x PARTITION BY k OPTIONS (description = 'as (select') AS ").otherwise(""),
        F.lit("WITH q AS (SELECT l_orderkey AS k, SUM(l_quantity * "), F.when(F.col("o_custkey") % 3 == 0, "l_tax").otherwise("l_discount"), F.lit(") AS v FROM tpch.lineitem GROUP BY 1) SELECT o.o_orderkey AS id, q.v AS amount, o.o_totalprice * "), "o_custkey", F.lit(" AS p"), F.col("o_custkey") % 7, F.lit(" FROM tpch.orders AS o JOIN q ON q.k = o.o_orderkey"),
    )
    d = o.select(F.lit("local").alias("object_project"), F.lit("tpch").alias("object_dataset"), F.concat(F.lit("v"), "o_orderkey").alias("object_name"), F.lit("VIEW").alias("object_type"), text.alias("definition_text"))
    return batch.edges(batch.run(d, catalog(spark, sf_dir))).select("target_object", F.concat_ws(".", "source_object", "source_column").alias("source"), "target_column")


@query("""WITH o AS (SELECT *, o_custkey % 4 AS r FROM orders) SELECT 'o' || o_orderkey AS object_name, CASE WHEN o_orderkey % 2 = 0 THEN 'VIEW' ELSE 'GENERATED_TABLE' END AS object_type, CASE WHEN r = 0 THEN 'NOT_ANALYZED' WHEN r = 1 THEN 'FAILED' ELSE 'NOT_REGISTERED' END AS coverage_reason
FROM o WHERE r IN (0, 1) AND o_orderstatus <> 'P' OR r = 2 AND o_orderstatus <> 'P' AND (o_orderkey % 2 = 0 OR o_orderpriority >= '3')""")
def coverage_gaps(spark, sf_dir):
    """Orders as objects: even ones are views, odd ones base tables; a quarter each failed, waits, is not registered, or is covered; status P is gone."""
    o, r = table(spark, sf_dir, "orders"), F.col("o_custkey") % 4
    name, h = F.concat(F.lit("o"), "o_orderkey"), F.sha2(F.col("o_orderkey").cast("string"), 256)
    id_ = [F.lit("p").alias("object_project"), F.lit("d").alias("object_dataset"), name.alias("object_name")]
    reg = o.filter(r != 2).select(*id_, F.when(F.col("o_orderkey") % 2 == 0, "VIEW").otherwise("TABLE").alias("object_type"), h.alias("definition_hash"), F.when(r == 0, None).otherwise(h).alias("last_analyzed_hash"), F.when(r == 1, "FAILED").when(r == 3, "COMPLETED").alias("analysis_status"), F.lit(True).alias("is_active"), F.lit(False).alias("is_ephemeral"), F.col("o_orderdate").alias("last_seen_at"))
    there = o.filter("o_orderstatus <> 'P'").select(F.lit("P").alias("project_id"), F.lit("D").alias("dataset_id"), F.upper(name).alias("table_name"), F.when(F.col("o_orderkey") % 2 == 0, "VIEW").otherwise("BASE TABLE").alias("table_type"))
    made = o.filter((F.col("o_orderpriority") >= "3") | (r != 2)).select(F.lit("p").alias("destination_project"), F.lit("d").alias("destination_dataset"), name.alias("destination_table"))
    return reports.coverage_gaps(reg, there, made).select("object_name", "object_type", "coverage_reason")


@query("""WITH t AS (SELECT max(ts) AS now FROM events), a AS (SELECT event_type AS dataset, 'v' || user_id % 7 AS view_name, max(ts) AS ts, count(*) AS n FROM events, t WHERE ts >= now - INTERVAL 10 DAY GROUP BY ALL)
SELECT c.dataset, c.view_name, coalesce(n, 0) AS query_count, date_diff('day', ts::DATE, now::DATE) AS days_since FROM (SELECT DISTINCT event_type AS dataset, 'v' || k AS view_name FROM events, range(8) AS r(k)) c CROSS JOIN t LEFT JOIN a USING (dataset, view_name)""")
def view_usage_window(spark, sf_dir):
    """Accesses of views in the days before a moment, with the views that nobody opened in them."""
    e = table(spark, sf_dir, "events")
    now = e.agg(F.max("ts").alias("now")).first().now
    log = e.select("ts", F.col("user_id").alias("user"), F.concat(F.lit("projects/p/datasets/"), F.col("event_type"), F.lit("/tables/v"), F.col("user_id") % 7).alias("v"))
    reg = e.select("event_type").distinct().select(F.lit("p").alias("object_project"), F.col("event_type").alias("object_dataset"), F.explode(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda k: F.concat(F.lit("v"), k))).alias("object_name"), F.lit("VIEW").alias("object_type"), F.lit(True).alias("is_active"))
    access = reports.view_access(log, F.array("v"), now=F.lit(now), days=10)
    return reports.last_access(reg, access, F.to_date(F.lit(now))).select("dataset", "view_name", F.coalesce("query_count", F.lit(0)).alias("query_count"), F.col("days_since").cast("long").alias("days_since"))


def _log(spark, sf_dir):
    """Orders as jobs: two of three accounts make tables, t0 to t9."""
    null = F.lit(None).cast("string")
    return table(spark, sf_dir, "orders").select(
        F.lit("P").alias("job_project"), F.col("o_orderkey").cast("string").alias("job_id"), null.alias("parent_job_id"), F.col("o_orderdate").cast("timestamp").alias("creation_time"), F.concat(F.lit("u"), F.col("o_custkey") % 3).alias("user_email"),
        F.lit("QUERY").alias("job_type"), F.lit("DONE").alias("state"), null.alias("error_reason"), F.when(F.col("o_orderstatus") == "F", "CREATE_TABLE_AS_SELECT").otherwise("SELECT").alias("statement_type"),
        F.concat(F.when(F.col("o_orderstatus") == "F", "create table x.y as ").otherwise(""), F.lit("select a from t where k = "), F.col("o_orderkey")).alias("query_text"), F.array().cast("array<struct<key:string,value:string>>").alias("labels"),
        F.lit("P").alias("destination_project"), F.lit("D").alias("destination_dataset"), F.concat(F.lit("T"), F.col("o_custkey") % 10).alias("destination_table"),
    )


ACCOUNTS = job_side.Accounts(dags=["u0", "u1"])


@query("""WITH j AS (SELECT *, o_custkey % 10 AS n FROM orders WHERE o_custkey % 3 < 2)
SELECT CASE WHEN n < 5 THEN 't' || n ELSE 'fp_' || sha256('SELECT A FROM T WHERE K = ?') END AS object_name, n >= 5 AS is_ephemeral, CASE WHEN n < 5 THEN 'd' ELSE 'dag' END AS object_dataset,
       arg_max(o_orderkey::VARCHAR, (o_orderdate, o_orderkey::VARCHAR)) AS source_job_id FROM j GROUP BY ALL""")
def generated_definitions(spark, sf_dir):
    tables = spark.createDataFrame([("p", "d", f"t{k}", None) for k in range(5)] + [("p", "d", "t5", dt.datetime(2030, 1, 1))], "project_id string, dataset_id string, table_name string, expiration_timestamp timestamp")
    jobs = job_side.collect(_log(spark, sf_dir), None, ACCOUNTS, F.lit("1990-01-01").cast("timestamp"))
    return job_side.generated(jobs, tables).select("object_name", "is_ephemeral", "object_dataset", "source_job_id")


@query("""SELECT o_orderkey::VARCHAR AS job_id, CASE WHEN o_custkey % 3 < 2 AND o_orderdate >= TIMESTAMP '1998-01-01' THEN 'u' || o_custkey % 3 ELSE 'old' END AS user_email, sha256('SELECT A FROM T WHERE K = ?') AS sql_fingerprint
FROM orders WHERE o_custkey % 3 < 2 AND (o_orderdate >= TIMESTAMP '1998-01-01' OR o_orderkey % 2 = 0)""")
def job_registry_upsert(spark, sf_dir):
    every = job_side.collect(_log(spark, sf_dir), None, ACCOUNTS, F.lit("1990-01-01").cast("timestamp"))
    old = every.filter("CAST(job_id AS LONG) % 2 = 0").withColumn("user_email", F.lit("old"))
    return job_side.collect(_log(spark, sf_dir), old, ACCOUNTS, F.lit("1998-01-04").cast("timestamp")).select("job_id", "user_email", "sql_fingerprint")


@query("""WITH r AS (SELECT DISTINCT o_custkey % 50 AS n FROM orders), s AS (SELECT DISTINCT o_custkey % 50 AS n FROM orders WHERE o_orderdate >= TIMESTAMP '2001-07-25')
SELECT 'o' || r.n AS object_name, CASE WHEN r.n % 2 = 0 THEN s.n IS NOT NULL ELSE r.n < 25 END AS is_active, CASE WHEN r.n % 2 = 0 AND s.n IS NULL THEN 'INACTIVE_FINGERPRINT_NOT_SEEN' WHEN r.n % 2 = 1 AND r.n >= 25 THEN 'INACTIVE_OBJECT_NOT_FOUND' ELSE 'COMPLETED' END AS analysis_status
FROM r LEFT JOIN s USING (n)""")
def age_out_ephemeral(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 50).alias("n"), F.col("o_orderdate").cast("timestamp").alias("creation_time"))
    name, print_ = F.concat(F.lit("o"), "n"), F.concat(F.lit("f"), "n")
    known = o.select("n").distinct()
    reg = known.select(F.lit("p").alias("object_project"), F.lit("d").alias("object_dataset"), name.alias("object_name"), print_.alias("sql_fingerprint"), (F.col("n") % 2 == 0).alias("is_ephemeral"), F.lit("DAG").alias("generation_type"), F.lit(True).alias("is_active"), F.lit(False).alias("is_changed"), F.lit("COMPLETED").alias("analysis_status"))
    tables = known.filter("n < 25").select(F.lit("P").alias("project_id"), F.lit("D").alias("dataset_id"), name.alias("table_name"), F.lit(None).cast("timestamp").alias("expiration_timestamp"))
    jobs = o.select(print_.alias("sql_fingerprint"), "creation_time")
    return job_side.retire(reg, tables, jobs, F.lit("2001-07-28").cast("timestamp"), 3).select("object_name", "is_active", "analysis_status")


@query("SELECT table_name, column_name, ordinal_position::INTEGER AS ordinal_position FROM information_schema.columns WHERE table_schema = 'main' AND table_name IN ('region', 'nation', 'customer', 'supplier', 'part', 'orders', 'lineitem', 'events', 'documents', 'embeddings', 'pages', 'benchmark', 'labels', 'conversations')")
def catalog_columns(spark, sf_dir):
    """Columns of all tables of the dataset that the given folder is, from their footers; other datasets beside it are not opened."""
    return catalogs.dataset_columns(spark, sf_dir).select("table_name", "column_name", "ordinal_position")


@query("SELECT o_orderkey, 'e' || strftime(o_orderdate, '%Y%m') AS shard FROM orders WHERE strftime(o_orderdate, '%Y%m') BETWEEN '199503' AND '199602' OR strftime(o_orderdate, '%Y%m') = '199701'")
def shard_suffix(spark, sf_dir):
    """Orders in a table for each month; the predicate on the suffix picks tables before any is opened."""
    o, at = table(spark, sf_dir, "orders"), scratch.folder(spark, "shards")
    o.select("o_orderkey", F.date_format("o_orderdate", "yyyyMM").alias("m")).repartition("m").write.partitionBy("m").parquet(at)
    x = sharded(spark, f"{at}/m=*", "_TABLE_SUFFIX BETWEEN '199503' AND '199602' OR _TABLE_SUFFIX = '199701'")
    return x.select("o_orderkey", F.concat(F.lit("e"), "_TABLE_SUFFIX").alias("shard"))


@query("SELECT 'a' AS run, o_orderkey, o_orderstatus AS state, 'published' AS outcome FROM orders WHERE o_orderstatus <> 'P' UNION ALL SELECT 'b', o_orderkey, 'old', 'rolled back' FROM orders WHERE o_orderstatus <> 'P'")
def script_restores(spark, sf_dir):
    """Two tries to make a new version current in a SQL script: one whose rows keep the rules, one whose rows break one."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("state"))
    old, rules = o.filter("state <> 'P'").withColumn("state", F.lit("old")), {"key": "o_orderkey IS NOT NULL", "state": "state IN ('F', 'O')"}
    good = script.switch(spark, {1: old, 2: o.filter("state <> 'P'")}, 1, 2, rules, "good_versions")
    bad = script.switch(spark, {1: old, 2: o}, 1, 2, rules, "bad_versions")
    return good.select(F.lit("a").alias("run"), "o_orderkey", "state", "outcome").unionByName(bad.select(F.lit("b").alias("run"), "o_orderkey", "state", "outcome"))


@query("SELECT count(*) FILTER (WHERE n > 0)::INTEGER AS done, count(*) FILTER (WHERE n = 0)::INTEGER AS skipped FROM (SELECT n_nationkey, count(s_suppkey) AS n FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey AND s_acctbal > 5000 GROUP BY 1)")
def script_loop(spark, sf_dir):
    """A statement for each nation that fails where no supplier is rich enough."""
    register_views(spark, sf_dir, ["nation", "supplier"])
    return script.each(spark, "nation", "n_nationkey", "SELECT assert_true(count(*) > 0) FROM supplier WHERE s_nationkey = :k AND s_acctbal > 5000")


@query("""WITH x AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 8 HOUR THEN 0 ELSE 1 END AS g FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
y AS (SELECT *, sum(g) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM x)
SELECT user_id::VARCHAR AS key, session::INTEGER AS session, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_at, count(*)::INTEGER AS n FROM y GROUP BY user_id, session""")
def table_function(spark, sf_dir):
    """A table function over events, partitioned by user and ordered by time."""
    tables.register(spark)
    table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("key"), "ts").createOrReplaceTempView("session_events")
    x = spark.sql("SELECT * FROM sessions(TABLE(session_events) PARTITION BY (key) ORDER BY (ts), 28800)")
    return x.select("key", "session", F.date_format("first_at", "yyyy-MM-dd HH:mm:ss").alias("first_at"), "n")


@query("SELECT o_orderkey, CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE round(o_totalprice / (o_custkey % 5), 4) END AS ratio, floor(o_totalprice / 1000)::BIGINT AS bucket, floor(o_totalprice / 50)::BIGINT AS fine, unnest(['o' || o_custkey, o_orderstatus]) AS part, unnest([0, 1]) AS place FROM orders")
def sql_functions(spark, sf_dir):
    """Functions written in SQL: a scalar one, one with a default, one that gives a table."""
    tables.register(spark)
    register_views(spark, sf_dir, ["orders"])
    return spark.sql("SELECT o_orderkey, round(safe_ratio(o_totalprice, o_custkey % 5), 4) AS ratio, bucket_of(o_totalprice) AS bucket, bucket_of(o_totalprice, 50) AS fine, p.part, p.place FROM orders, LATERAL parts_of('o' || o_custkey || '.' || o_orderstatus) p")


@query("""WITH j AS (SELECT strftime(o_orderdate, '%Y%m') AS m, max(o_orderdate) AS seen, arg_max(o_orderkey::VARCHAR, (o_orderdate, o_orderkey::VARCHAR)) AS job_id FROM orders GROUP BY 1)
SELECT sha256('SELECT A FROM T' || m || ' WHERE K = ?') AS fingerprint, job_id, seen + INTERVAL 732 HOUR < (SELECT max(o_orderdate) FROM orders) - INTERVAL 3 DAY AS retired FROM j""")
def stream_latest_jobs(spark, sf_dir):
    """Orders as a stream of jobs, a fingerprint for each month: its latest job, and whether it has retired when all have arrived."""
    o, at = table(spark, sf_dir, "orders"), scratch.folder(spark, "jobs")
    jobs = o.select(F.col("o_orderkey").cast("string").alias("job_id"), F.col("o_orderdate").cast("timestamp").alias("creation_time"), F.lit("u").alias("user_email"), F.concat(F.lit("select a from t"), F.date_format("o_orderdate", "yyyyMM"), F.lit(" where k = "), "o_orderkey").alias("query_text"))
    for rows in (jobs, jobs.orderBy(F.desc("creation_time"), F.desc("job_id")).limit(1)):  # the second arrival moves time on
        rows.write.mode("append").parquet(f"{at}/in")
        stream = spark.readStream.schema(collector.JOB_LOG).parquet(f"{at}/in")
        collector.collect(collector.latest_jobs(stream, dt.timedelta(hours=732)), f"{at}/state", lambda batch, number: batch.write.mode("overwrite").parquet(f"{at}/events/batch={number}"), "update")
    events = spark.read.schema(collector.EVENTS + ", batch long").option("basePath", f"{at}/events").parquet(f"{at}/events/*")
    last = F.struct("batch", "creation_time", "job_id")
    return events.groupBy("fingerprint").agg(F.max_by("job_id", last).alias("job_id"), F.bool_or(F.col("event") == "RETIRED").alias("retired"))
