"""Queries over the driver's tables, one or more for each construct of the dialect, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from weftline.functions import dates
from weftline.functions.analysis import variables_column
from weftline.operators import relational as R, windows
from weftline.repository import proposals as P, registry as G
from weftline.sources.readers import register_views, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    """Register a function (spark, tables by name) under its name."""

    def add(f):
        def run(spark, sf_dir: str):
            return f(spark, lambda n: table(spark, sf_dir, n))

        QUERIES[f.__name__] = run
        SQL[f.__name__] = sql
        return f

    return add


def same(name: str, sql: str, spark_sql: str | None = None) -> None:
    """Register a query whose text both engines read."""

    def run(spark, sf_dir: str):
        register_views(spark, sf_dir)
        return spark.sql(spark_sql or sql)

    QUERIES[name], SQL[name] = run, sql


# -- projections, filters, predicates ----------------------------------------
same("project_alias", "SELECT o_orderkey AS k, o_totalprice AS price, o_orderkey + o_custkey AS s FROM orders WHERE o_totalprice > 300000")
same("star_except", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders", "SELECT * EXCEPT (o_totalprice, o_orderdate, o_orderpriority) FROM orders")
same("select_distinct", "SELECT DISTINCT o_orderstatus AS st, o_orderpriority AS pr FROM orders")
same("predicates_mix", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE (l_quantity BETWEEN 10 AND 20 OR l_returnflag IN ('R', 'A')) AND NOT l_linestatus = 'O' AND l_discount IS NOT NULL AND l_tax <> 0.0")
same("like_any", "SELECT p_partkey, p_name FROM part WHERE (p_name LIKE 'small%' OR p_name LIKE '%bolt' OR p_name LIKE 'r_d%') AND p_type NOT LIKE 'ECON%'", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE ANY ('small%', '%bolt', 'r_d%') AND p_type NOT LIKE 'ECON%'")
same("like_all", "SELECT p_partkey, p_name LIKE '%e%' AND p_name LIKE '%d%' AS every, NOT (p_name LIKE '%e%' OR p_name LIKE '%i%') AS not_any, NOT (p_name LIKE '%e%' AND p_name LIKE '%i%') AS some_not FROM part", "SELECT p_partkey, p_name LIKE ALL ('%e%', '%d%') AS every, p_name NOT LIKE ALL ('%e%', '%i%') AS not_any, p_name NOT LIKE SOME ('%e%', '%i%') AS some_not FROM part")
same("is_distinct_from", "SELECT o_orderkey FROM orders WHERE o_orderstatus IS DISTINCT FROM 'F' AND (o_totalprice > 1e5) IS TRUE")
same("in_subquery", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
same("not_exists", "SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 250000)")
same("exists_in_case", "SELECT c_custkey, CASE WHEN EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 200000) THEN 'big' ELSE 'small' END AS size_class FROM customer c")
same("having_alias", "SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 5")
same("no_from", "SELECT 1 AS one, 'x' AS s, NULL IS NULL AS b")


@query("SELECT o_orderkey, o_custkey, o_totalprice * 2 AS o_totalprice, lower(o_orderstatus) AS o_orderstatus FROM orders")
def star_replace(spark, t):
    o = t("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    return R.star(o, replace={"o_totalprice": F.col("o_totalprice") * 2, "o_orderstatus": F.lower("o_orderstatus")})


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 2")
def qualify_topk(spark, t):
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return R.qualify(t("orders").select("o_custkey", "o_orderkey", "o_totalprice"), F.row_number().over(w) <= 2)


@query("SELECT c_custkey, {'name': c_name, 'seg': c_mktsegment}.name AS n, {'name': c_name, 'seg': c_mktsegment}.seg AS s FROM customer")
def struct_fields(spark, t):
    return t("customer").select("c_custkey", F.struct(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("seg")).alias("x")).select("c_custkey", F.col("x.name").alias("n"), F.col("x.seg").alias("s"))


# -- joins ------------------------------------------------------------------
same("inner_join", "SELECT o.o_orderkey, c.c_name FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey WHERE o.o_totalprice > 250000")
same("left_join", "SELECT c.c_custkey, count(o.o_orderkey) AS n FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey GROUP BY c.c_custkey")
same("full_outer", "SELECT coalesce(a.c_nationkey, -1) AS cn, coalesce(b.s_nationkey, -1) AS sn, coalesce(a.n, 0) AS na, coalesce(b.n, 0) AS nb FROM (SELECT c_nationkey, count(*) AS n FROM customer WHERE c_acctbal > 9000 GROUP BY c_nationkey) a FULL OUTER JOIN (SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY s_nationkey) b ON a.c_nationkey = b.s_nationkey")
same("right_join", "SELECT n.n_name, s.s_suppkey FROM supplier s RIGHT JOIN nation n ON s.s_nationkey = n.n_nationkey")
same("comma_join", "SELECT n.n_name, r.r_name FROM nation n, region r WHERE n.n_regionkey = r.r_regionkey")
same("using_join", "SELECT k, n_name, cnt FROM (SELECT n_nationkey AS k, n_name FROM nation) a JOIN (SELECT c_nationkey AS k, count(*) AS cnt FROM customer GROUP BY c_nationkey) b USING (k)")
same("theta_join", "SELECT a.n_nationkey AS x, b.n_nationkey AS y FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey")
same("self_join_cte", "WITH m AS (SELECT o_custkey AS k, max(o_totalprice) AS p FROM orders GROUP BY o_custkey) SELECT a.k AS k, a.p AS p, b.k AS nxt FROM m a JOIN m b ON b.k = a.k + 1")


@query("SELECT o_orderkey, o_custkey FROM orders SEMI JOIN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45) l ON o_orderkey = l_orderkey")
def semi_join(spark, t):
    return t("orders").select("o_orderkey", "o_custkey").join(t("lineitem").filter("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_semi")


# -- aggregation ---------------------------------------------------------------
same("pricing_summary", "SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 1) AS revenue, count(*) AS n, round(avg(l_discount), 6) AS avg_disc FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02 00:00:00' GROUP BY l_returnflag, l_linestatus")
same("rollup_nation", "SELECT r_name, n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)")
same("cube_segment", "SELECT c_mktsegment, n_regionkey, count(*) AS n, round(sum(c_acctbal), 2) AS bal FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY CUBE (c_mktsegment, n_regionkey)")
same("grouping_sets", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())")
same("group_by_all", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL")
same("group_ordinal", "SELECT o_orderstatus, count(DISTINCT o_custkey) AS n FROM orders GROUP BY 1")
same("count_if", "SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS f, bool_or(o_totalprice > 300000) AS big, bool_and(o_totalprice > 1000) AS all_ok FROM orders GROUP BY o_custkey", "SELECT o_custkey, count_if(o_orderstatus = 'F') AS f, bool_or(o_totalprice > 300000) AS big, bool_and(o_totalprice > 1000) AS all_ok FROM orders GROUP BY o_custkey")
same("window_of_aggregate", "SELECT o_custkey, o_orderstatus, count(*) AS n, sum(count(*)) OVER (PARTITION BY o_custkey)::BIGINT AS total FROM orders GROUP BY o_custkey, o_orderstatus", "SELECT o_custkey, o_orderstatus, count(*) AS n, sum(count(*)) OVER (PARTITION BY o_custkey) AS total FROM orders GROUP BY o_custkey, o_orderstatus")


@query("SELECT l_orderkey, array_to_string(list(l_linenumber ORDER BY l_linenumber, l_partkey), ',') AS lines FROM lineitem GROUP BY l_orderkey")
def ordered_struct_agg(spark, t):
    x = t("lineitem").groupBy("l_orderkey").agg(R.ordered_list(F.col("l_linenumber"), F.struct("l_linenumber", "l_partkey")).alias("a"))
    return x.select("l_orderkey", F.array_join(F.transform("a", lambda v: v.cast("string")), ",").alias("lines"))


@query("SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_fin, count(*) FILTER (WHERE o_orderstatus = 'O') AS n_open, max(o_orderkey) FILTER (WHERE o_orderstatus = 'F') AS last_fin, max(o_orderkey) FILTER (WHERE o_orderstatus = 'O') AS last_open FROM orders GROUP BY o_custkey")
def pivot_multi_agg(spark, t):
    o = t("orders").select("o_custkey", "o_orderstatus", "o_orderkey")
    x = R.pivot(o, ["o_custkey"], "o_orderstatus", {"F": "fin", "O": "open"}, {"n": F.count("o_orderkey"), "last": F.max("o_orderkey")})
    return x.select("o_custkey", F.coalesce("n_fin", F.lit(0)).alias("n_fin"), F.coalesce("n_open", F.lit(0)).alias("n_open"), "last_fin", "last_open")


@query("SELECT o_orderpriority, max(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS \"F\", max(o_totalprice) FILTER (WHERE o_orderstatus = 'O') AS \"O\", max(o_totalprice) FILTER (WHERE o_orderstatus = 'P') AS \"P\" FROM orders GROUP BY o_orderpriority")
def pivot_status(spark, t):
    return R.pivot(t("orders").select("o_orderpriority", "o_orderstatus", "o_totalprice"), ["o_orderpriority"], "o_orderstatus", {"F": "F", "O": "O", "P": "P"}, {None: F.max("o_totalprice")})


@query("SELECT l_orderkey, l_linenumber, metric, v FROM (UNPIVOT (SELECT l_orderkey, l_linenumber, l_partkey, l_tax, l_discount FROM lineitem) ON l_tax, l_discount INTO NAME metric VALUE v) AS x(l_orderkey, l_linenumber, l_partkey, metric, v)")
def unpivot_amounts(spark, t):
    return R.unpivot(t("lineitem"), ["l_orderkey", "l_linenumber"], {"l_tax": ["l_tax"], "l_discount": ["l_discount"]}, ["v"], "metric")


@query("SELECT l_orderkey, l_linenumber, 'price' AS k, l_extendedprice AS a, l_discount AS b FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber, 'qty', l_quantity, l_tax FROM lineitem")
def unpivot_multi(spark, t):
    return R.unpivot(t("lineitem"), ["l_orderkey", "l_linenumber"], {"price": ["l_extendedprice", "l_discount"], "qty": ["l_quantity", "l_tax"]}, ["a", "b"], "k")


# -- windows -----------------------------------------------------------------
same("ranks", "SELECT o_orderkey, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS r, dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS d, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders", "SELECT o_orderkey, CAST(rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS BIGINT) AS r, CAST(dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS BIGINT) AS d, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS n FROM orders")
same("running_sum", "SELECT o_orderkey, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cents FROM orders")
same("lag_lead", "SELECT event_id, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nx FROM events")
same("named_window", "SELECT o_orderkey, first_value(o_orderkey) OVER w AS f, count(*) OVER w AS c FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)")
same("ignore_nulls", "SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_purchase FROM events", "SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN event_id END) IGNORE NULLS OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_purchase FROM events")
@query("SELECT o_orderkey, count(*) OVER (PARTITION BY o_orderstatus ORDER BY o_custkey RANGE BETWEEN 5 PRECEDING AND 5 FOLLOWING) AS near FROM orders")
def range_frame(spark, t):
    o = t("orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    return windows.range_frame(o, ["o_orderstatus"], "o_custkey", {"near": ("count", F.lit(1))}, 5, 5).select("o_orderkey", "near")



@query("SELECT o_orderkey, sum(o_orderkey) OVER (PARTITION BY o_orderstatus ORDER BY o_custkey GROUPS BETWEEN 1 PRECEDING AND CURRENT ROW)::BIGINT AS s FROM orders")
def groups_frame(spark, t):
    o = t("orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    return windows.groups_frame(o, ["o_orderstatus"], "o_custkey", {"s": ("sum", F.col("o_orderkey"))}, 1).select("o_orderkey", "s")


@query("""SELECT o_orderkey, row_number() OVER w AS n, sum(o_custkey) OVER w::BIGINT AS s, max(o_custkey) OVER w AS m, lag(o_orderkey, 2) OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey) AS two_before, lead(o_orderkey) OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey) AS following
FROM orders WINDOW w AS (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def running_few_keys(spark, t):
    """Running aggregates, LAG and LEAD over three partitions of the table, spread over all tasks."""
    o, keys, order = t("orders").select("o_orderkey", "o_orderstatus", "o_orderdate", "o_custkey"), ["o_orderstatus"], ["o_orderdate", "o_orderkey"]
    x = windows.running(o, keys, order, {"n": ("count", F.lit(1)), "s": ("sum", F.col("o_custkey")), "m": ("max", F.col("o_custkey"))})
    return windows.shifted(x, keys, order, {"two_before": (F.col("o_orderkey"), 2), "following": (F.col("o_orderkey"), -1)}).select("o_orderkey", "n", "s", "m", "two_before", "following")


@query("""WITH x AS (SELECT event_type, ts, event_id, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 1 HOUR THEN 0 ELSE 1 END AS g FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id))
SELECT event_id, sum(g) OVER (PARTITION BY event_type ORDER BY ts, event_id)::BIGINT AS island FROM x""")
def islands_few_keys(spark, t):
    """Runs of one kind of event without a gap of an hour; a handful of kinds, spread over all tasks."""
    e, near = t("events").select("event_type", "ts", "event_id"), F.col("ts") - F.col("_before") <= F.expr("INTERVAL 1 HOUR")
    return windows.islands(e, ["event_type"], ["ts", "event_id"], ~F.coalesce(near, F.lit(False)), {"_before": F.col("ts")}).select("event_id", "island")

@query("WITH x AS (SELECT user_id, ts, event_id, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS g FROM events), y AS (SELECT *, sum(g) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM x) SELECT user_id, island::BIGINT AS island, count(*) AS n FROM y GROUP BY user_id, island")
def islands(spark, t):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    near = F.col("ts") - F.lag("ts").over(w) <= F.expr("INTERVAL 6 HOUR")
    x = t("events").select("user_id", "ts", "event_id").withColumn("g", F.when(near, 0).otherwise(1))
    return R.islands(x, ["user_id"], F.struct("ts", "event_id"), F.col("g")).groupBy("user_id", "island").agg(F.count(F.lit(1)).alias("n"))


# -- order, limit, sets --------------------------------------------------------
same("order_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 20 OFFSET 5")
same("set_union_distinct", "SELECT o_custkey AS k FROM orders WHERE o_totalprice > 200000 UNION SELECT c_custkey FROM customer WHERE c_acctbal < 0")
same("set_union_all", "SELECT n_name AS x FROM nation UNION ALL SELECT r_name FROM region UNION ALL SELECT s_name FROM supplier")
same("set_intersect", "SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O'")
same("set_except_all", "SELECT o_custkey AS k FROM orders EXCEPT ALL SELECT c_custkey FROM customer")
same("set_intersect_all", "SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F' INTERSECT ALL SELECT o_custkey FROM orders WHERE o_orderstatus = 'O'")
same("set_chain", "SELECT n_nationkey AS k FROM nation UNION SELECT c_custkey FROM customer EXCEPT SELECT s_suppkey FROM supplier", "(SELECT n_nationkey AS k FROM nation UNION SELECT c_custkey FROM customer) EXCEPT SELECT s_suppkey FROM supplier")

# -- scalar expressions ----------------------------------------------------------
same("arithmetic", "SELECT l_orderkey, l_linenumber, CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT)) AS charge, -l_linenumber AS neg, l_orderkey % 7 AS m FROM lineitem")
same("safe_divide", "SELECT o_orderkey, CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE round(o_totalprice / (o_custkey % 5), 4) END AS q FROM orders", "SELECT o_orderkey, round(try_divide(o_totalprice, o_custkey % 5), 4) AS q FROM orders")
same("safe_cast", "SELECT event_id, TRY_CAST(replace(event_type, 'error', '7') AS INTEGER) AS n FROM events")
same("case_forms", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 0 END AS a, CASE WHEN o_totalprice > 1e5 THEN 'x' END AS b, nullif(o_orderstatus, 'P') AS c FROM orders")
same("extract_parts", "SELECT o_orderkey, CAST(extract(year FROM o_orderdate) AS BIGINT) AS y, CAST(extract(month FROM o_orderdate) AS BIGINT) AS m FROM orders")
same("date_trunc_month", "SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS mon, count(*) AS n FROM orders GROUP BY 1", "SELECT date_format(date_trunc('month', o_orderdate), 'yyyy-MM-dd') AS mon, count(*) AS n FROM orders GROUP BY 1")
same("interval_math", "SELECT count(*) AS n FROM orders WHERE o_orderdate < TIMESTAMP '1997-06-30 00:00:00' - INTERVAL 30 DAY")
same("string_functions", "SELECT c_custkey, upper(c_mktsegment) || '-' || lower(c_name) AS u, replace(c_name, '#', ':') AS r, length(trim(c_name)) AS n, strpos(c_name, '#') AS p FROM customer", "SELECT c_custkey, upper(c_mktsegment) || '-' || lower(c_name) AS u, replace(c_name, '#', ':') AS r, CAST(length(trim(c_name)) AS BIGINT) AS n, CAST(instr(c_name, '#') AS BIGINT) AS p FROM customer")
same("regex_functions", "SELECT p_partkey, regexp_matches(p_brand, '#1[0-9]') AS m, regexp_extract(p_brand, '#([0-9])', 1) AS d, regexp_replace(p_name, '[aeiou]', '_', 'g') AS v FROM part", "SELECT p_partkey, p_brand RLIKE '#1[0-9]' AS m, regexp_extract(p_brand, '#([0-9])', 1) AS d, regexp_replace(p_name, '[aeiou]', '_') AS v FROM part")
same("hash_hex", "SELECT c_custkey, sha256(c_name) AS h FROM customer", "SELECT c_custkey, sha2(c_name, 256) AS h FROM customer")
same("json_extract", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events", "SELECT event_id, CAST(get_json_object(props, '$.k') AS BIGINT) AS k FROM events")
same("array_subquery", "SELECT n_nationkey, coalesce(array_to_string(list_sort(ARRAY(SELECT s_suppkey FROM supplier WHERE s_nationkey = n_nationkey)), ','), '') AS suppliers FROM nation", "SELECT n_nationkey, coalesce((SELECT array_join(array_sort(collect_list(s_suppkey)), ',') FROM supplier WHERE s_nationkey = n_nationkey), '') AS suppliers FROM nation")
same("scalar_subquery", "SELECT o_orderkey FROM orders o WHERE o_totalprice = (SELECT max(o_totalprice) FROM orders i WHERE i.o_custkey = o.o_custkey)")
same("nested_cte", "WITH a AS (SELECT o_custkey AS k, sum(o_totalprice) AS s FROM orders GROUP BY o_custkey), b AS (SELECT k, s FROM a WHERE s > (SELECT avg(s) FROM a)) SELECT n_name, count(*) AS n FROM b JOIN customer ON k = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
same("recursive_cte_paths", "WITH RECURSIVE c AS (SELECT n_nationkey AS k, 1 AS depth FROM nation WHERE n_nationkey < 5 UNION ALL SELECT n.n_nationkey, c.depth + 1 FROM c JOIN nation n ON n.n_nationkey = c.k + 5 WHERE c.depth < 5) SELECT k, depth FROM c", "WITH RECURSIVE c(k, depth) AS (SELECT n_nationkey, 1 FROM nation WHERE n_nationkey < 5 UNION ALL SELECT n.n_nationkey, c.depth + 1 FROM c JOIN nation n ON n.n_nationkey = c.k + 5 WHERE c.depth < 5) SELECT k, depth FROM c")


@query("SELECT c_custkey, c_nationkey FROM customer WHERE ('0x' || left(sha256('7:' || c_custkey), 8))::BIGINT < 4294967296 * 0.2")
def table_sample(spark, t):
    return R.sample(t("customer"), ["c_custkey"], 20, 7).select("c_custkey", "c_nationkey")


@query("SELECT vec_id, round(embedding[1], 5)::DOUBLE AS a, len(embedding)::INTEGER AS n, embedding[9999] IS NULL AS out_of_range FROM embeddings")
def array_subscript(spark, t):
    e = F.col("embedding")
    return t("embeddings").select("vec_id", F.round(e[0], 5).cast("double").alias("a"), F.size(e).alias("n"), F.get(e, F.lit(9998)).isNull().alias("out_of_range"))


@query("SELECT vec_id, i::INTEGER AS o, v::DOUBLE AS x FROM (SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings)")
def unnest_offset(spark, t):
    x = t("embeddings").select("vec_id", F.posexplode("embedding").alias("o", "v"))
    return x.select("vec_id", "o", F.col("v").cast("double").alias("x"))


@query("SELECT o_custkey, array_to_string(list(o_orderkey ORDER BY o_totalprice DESC, o_orderkey)[1:3], ',') AS top, string_agg(DISTINCT o_orderpriority, '|' ORDER BY o_orderpriority) AS priorities, arg_max(o_orderstatus, (o_totalprice, o_orderkey)) AS of_largest, list(nullif(o_orderstatus, 'P') ORDER BY o_orderdate, o_orderkey) FILTER (WHERE o_orderstatus <> 'P')[1] AS first_known FROM orders GROUP BY o_custkey")
def aggregate_modifiers(spark, t):
    """ARRAY_AGG with ORDER BY and LIMIT, STRING_AGG with DISTINCT and ORDER BY, ANY_VALUE HAVING MAX, IGNORE NULLS."""
    o, k = t("orders"), ["o_custkey"]
    known = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    x = o.groupBy(*k).agg(F.array_join(F.array_sort(F.collect_set("o_orderpriority")), "|").alias("priorities"), F.max_by("o_orderstatus", F.struct("o_totalprice", "o_orderkey")).alias("of_largest"))
    top = R.first_of_group(o, k, F.col("o_orderkey"), [F.desc("o_totalprice"), F.asc("o_orderkey")], 3, "top")
    first = R.first_of_group(o, k, known, [F.asc("o_orderdate"), F.asc("o_orderkey")], 1, "first")
    return x.join(top, k).join(first, k).select(*k, F.array_join("top", ",").alias("top"), "priorities", "of_largest", F.get("first", F.lit(0)).alias("first_known"))


@query("SELECT o_orderstatus, array_to_string(list(o_orderkey ORDER BY o_totalprice DESC, o_orderkey)[1:5], ',') AS top FROM orders GROUP BY o_orderstatus")
def top_of_hot_groups(spark, t):
    """ARRAY_AGG with ORDER BY and LIMIT over three groups that hold the whole table."""
    top = R.first_of_group(t("orders"), ["o_orderstatus"], F.col("o_orderkey"), [F.desc("o_totalprice"), F.asc("o_orderkey")], 5, "top")
    return top.select("o_orderstatus", F.array_join("top", ",").alias("top"))


@query("SELECT n_nationkey, v FROM nation LEFT JOIN (SELECT n_nationkey AS k, unnest(CASE WHEN n_nationkey % 2 = 0 THEN [n_nationkey, n_regionkey] ELSE [] END) AS v FROM nation) ON k = n_nationkey")
def left_join_unnest(spark, t):
    items = F.when(F.col("n_nationkey") % 2 == 0, F.array("n_nationkey", "n_regionkey")).otherwise(F.array().cast("array<int>"))
    return t("nation").select("n_nationkey", F.explode_outer(items).alias("v"))


@query("SELECT o_orderkey FROM orders WHERE list_contains(['1-URGENT', '2-HIGH'], o_orderpriority)")
def in_unnest(spark, t):
    return t("orders").filter(F.array_contains(F.array(F.lit("1-URGENT"), F.lit("2-HIGH")), F.col("o_orderpriority"))).select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_totalprice > 250000 AND o_orderstatus = 'F'")
def query_parameters(spark, t):
    t("orders").createOrReplaceTempView("orders")
    return spark.sql("SELECT o_orderkey FROM orders WHERE o_totalprice > :least AND o_orderstatus = :status", args={"least": 250000, "status": "F"})


@query("SELECT o_orderkey, strftime(o_orderdate, '%U')::INTEGER AS sunday_week, strftime(o_orderdate, '%W')::INTEGER AS monday_week, strftime(date_trunc('week', o_orderdate), '%Y-%m-%d') AS monday, extract(hour FROM o_orderdate + INTERVAL 9 HOUR)::INTEGER AS tokyo_hour, extract(day FROM o_orderdate - INTERVAL 3 HOUR)::INTEGER AS santos_day FROM orders")
def date_parts(spark, t):
    """WEEK, WEEK(MONDAY), DATE_TRUNC to WEEK(MONDAY) and parts AT TIME ZONE."""
    o, d = t("orders"), F.col("o_orderdate")
    return o.select("o_orderkey", dates.week(d).alias("sunday_week"), dates.week(d, "MONDAY").alias("monday_week"), F.date_format(dates.trunc_week(d, "MONDAY"), "yyyy-MM-dd").alias("monday"), F.hour(dates.at_zone(d, "Asia/Tokyo")).alias("tokyo_hour"), F.dayofmonth(dates.at_zone(d, "-03:00")).alias("santos_day"))


@query("SELECT o_custkey, max(o_orderkey) AS k, arg_max(o_orderstatus, o_orderkey) AS st, arg_max(left(o_orderpriority, 1), o_orderkey) AS p FROM orders GROUP BY o_custkey")
def select_as_value(spark, t):
    """SELECT AS STRUCT in a subquery, its fields and nested fields (f(x).y and a.b.c), and SELECT AS VALUE that unpacks it."""
    t("orders").createOrReplaceTempView("orders")
    x = spark.sql("SELECT o_custkey, max_by(struct(o_orderkey AS k, struct(o_orderstatus AS st, struct(left(o_orderpriority, 1) AS p) AS deep) AS s), o_orderkey) AS v FROM orders GROUP BY o_custkey")
    return x.select("o_custkey", "v.*").select("o_custkey", "k", "s.st", "s.deep.p")


@query("SELECT n_nationkey + 10 AS id, CASE WHEN n_nationkey + 10 < 25 THEN '{\"id\":' || n_nationkey + 10 || ',\"name\":\"' || (SELECT m.n_name FROM nation m WHERE m.n_nationkey = nation.n_nationkey + 10) || '\"}' ELSE '{\"error\":\"id=' || n_nationkey + 10 || ' is not known\"}' END AS answer FROM nation")
def tool_answers(spark, t):
    """A row or an error for each asked id."""
    n = t("nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    return P.answers(n.select((F.col("id") + 10).alias("id")), n)


# -- registries and samples ------------------------------------------------------
@query("SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders GROUP BY o_custkey")
def latest_per_group(spark, t):
    return G.latest(t("orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).select("o_custkey", "o_orderkey")


@query("SELECT p_partkey FROM part WHERE regexp_matches(lower(p_name), 'cold|widget') AND NOT regexp_matches(lower(p_type), 'promo')")
def include_exclude_regex(spark, t):
    return t("part").filter(G.matches(F.col("p_name"), ["COLD", "widget"], []) & G.matches(F.col("p_type"), [], ["promo"])).select("p_partkey")


@query("""WITH o AS (SELECT o_orderkey AS k, sha256(o_orderstatus) AS h FROM orders WHERE o_orderkey % 3 <> 0),
n AS (SELECT o_orderkey AS k, sha256(CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END) AS h FROM orders WHERE o_orderkey % 2 = 0)
SELECT coalesce(o.k, n.k) AS object_name, coalesce(n.h, o.h) AS definition_hash, CASE WHEN n.h <> o.h THEN o.h END AS previous_definition_hash, n.h IS NOT NULL AND (o.h IS NULL OR n.h <> o.h) AS is_changed
FROM o FULL JOIN n ON o.k = n.k""")
def registry_upsert(spark, t):
    o = t("orders")
    key = F.col("o_orderkey").alias("object_name")
    old = o.filter("o_orderkey % 3 <> 0").select(key, F.sha2("o_orderstatus", 256).alias("definition_hash"), F.lit(None).cast("string").alias("previous_definition_hash"), F.lit(False).alias("is_changed"), F.lit(True).alias("is_active"), F.lit("COMPLETED").alias("analysis_status"))
    new = o.filter("o_orderkey % 2 = 0").select(key, F.sha2(F.when(F.col("o_orderkey") % 5 == 0, "X").otherwise(F.col("o_orderstatus")), 256).alias("definition_hash"))
    return G.upsert(old, new, ["object_name"]).select("object_name", "definition_hash", "previous_definition_hash", "is_changed")


@query("""WITH c AS (SELECT c_custkey AS k, 'd' || c_nationkey % 2 AS dataset, c_acctbal > 0 AS was, c_custkey IN (SELECT o_custkey FROM orders) AS found FROM customer)
SELECT k, was AND (found OR dataset = 'd0') AS is_active, CASE WHEN NOT was THEN 'OLD' WHEN found OR dataset = 'd0' THEN 'COMPLETED' ELSE 'INACTIVE_OBJECT_NOT_FOUND' END AS analysis_status, NOT (was AND NOT found AND dataset = 'd1') AS is_changed FROM c""")
def deactivate_missing(spark, t):
    """Two datasets of which d1 is scanned: what it lacks goes out of service, d0 and what was inactive stay."""
    c = t("customer").select(F.col("c_custkey").alias("k"), F.concat(F.lit("d"), F.col("c_nationkey") % 2).alias("dataset"), (F.col("c_acctbal") > 0).alias("is_active"))
    reg = c.withColumn("analysis_status", F.when(F.col("is_active"), "COMPLETED").otherwise("OLD")).withColumn("is_changed", F.lit(True))
    return G.deactivate_missing(reg, t("orders").select(F.col("o_custkey").alias("k")), F.col("dataset") == "d1", ["k"]).select("k", "is_active", "analysis_status", "is_changed")


@query("SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT') AND o_custkey % 2 = 0 THEN 'SCHEDULED_QUERY' WHEN o_custkey % 3 = 0 THEN 'DAG' END AS kind, CASE WHEN o_orderpriority IN ('1-URGENT') AND o_custkey % 2 = 0 THEN 'LABEL_AND_ACCOUNT' WHEN o_custkey % 3 = 0 THEN 'USER_EMAIL' END AS reason FROM orders")
def job_classify(spark, t):
    labels = F.array(F.struct(F.col("o_orderpriority").alias("key"), F.lit("v").alias("value")))
    email = F.concat(F.lit("u"), F.col("o_custkey") % 6)
    kind, reason = G.classify(labels, email, "1-URGENT", ["u0", "u2", "u4"], ["u0", "u3"])
    return t("orders").select("o_orderkey", kind.alias("kind"), reason.alias("reason"))


@query("SELECT o_orderkey, 'v' || o_orderkey || ',w' || CASE WHEN o_custkey % 2 = 0 THEN ',z' ELSE '' END AS names FROM orders")
def declare_vars(spark, t):
    text = F.concat(F.lit("declare V"), F.col("o_orderkey"), F.lit(", w INT64; -- DECLARE no;\nDECLARE "), F.when(F.col("o_custkey") % 2 == 0, "z").otherwise(F.concat(F.lit("v"), F.col("o_orderkey"))), F.lit(" STRING DEFAULT 'x';"))
    return t("orders").select("o_orderkey", text.alias("q")).select("o_orderkey", F.array_join(variables_column("q"), ",").alias("names"))


@query("SELECT doc_id, length(trim(source)) > 0 AND length(text) >= 40 AND quality = 1 AS passes, round((quality + toxic + 3) / 3.0, 1) AS score FROM labels JOIN documents USING (doc_id)")
def rule_gate(spark, t):
    d = t("labels").join(t("documents").select("doc_id", "source", "text"), "doc_id")
    ids, catalog, expected = F.array("quality"), F.array(F.lit(0), F.lit(1)), F.array(F.lit(1))
    return d.select("doc_id", P.gate(F.col("source"), F.col("text"), ids, catalog, expected).alias("passes"), P.judge(F.col("quality"), F.col("toxic"), F.lit(3)).alias("score"))


@query("SELECT n_nationkey, list_aggregate(list_filter([n_nationkey, n_regionkey, 3], lambda x: NOT list_contains([n_regionkey, 7], x)), 'string_agg', ',') AS added, CASE WHEN 7 IN (n_nationkey, n_regionkey, 3) THEN NULL ELSE '7' END AS removed FROM nation")
def set_compare(spark, t):
    old, new = F.array("n_regionkey", F.lit(7)), F.array("n_nationkey", "n_regionkey", F.lit(3))
    added, removed, _ = P.compare(old, new)
    text = lambda c: F.when(F.size(c) > 0, F.array_join(F.transform(c, lambda x: x.cast("string")), ","))
    return t("nation").select("n_nationkey", text(added).alias("added"), text(removed).alias("removed"))


@query("SELECT max(o_orderkey) + 1 AS next_id FROM orders")
def next_id(spark, t):
    return P.next_id(t("orders"), "o_orderkey").select(F.col("next_id").cast("long").alias("next_id"))
