"""Downstream impact: bounded closure of the edges with paths, and what is joined to it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weftline.sources import scratch

USABLE = ("RESOLVED", "SOURCE_RESOLVED", "PARTIALLY_RESOLVED")
# How the kinds of usage are reported.
ROW_USAGES = ["WHERE", "JOIN", "JOIN_ON", "GROUP_BY", "HAVING", "QUALIFY", "ORDER_BY", "WINDOW_PARTITION", "WINDOW_ORDER"]
VALUE_USAGES = ["SELECT", "EXPRESSION", "UNNEST"]


def ready(spark: SparkSession) -> None:
    """A folder for checkpoint() in the shared place."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(scratch.root(spark))


def _label(o, c) -> Column:
    return F.concat_ws(".", o, F.coalesce(c, F.lit("*")))


EDGE = ["source", "source_column", "target", "target_column"]
#: A closure without its path's hash.
PATHS = "origin string, origin_column string, impact_rank int, impacted string, impacted_column string, path array<string>, is_cycle boolean"


def usable(edges: DataFrame) -> DataFrame:
    """Distinct edges that the closure follows, names in lower case."""
    return edges.filter(F.col("resolution_status").isin(*USABLE)).select(*[F.lower(c).alias(c) for c in EDGE]).distinct()


def _first(e: DataFrame) -> DataFrame:
    """Edges as paths of one step."""
    return e.select(
        F.col("source").alias("origin"), F.col("source_column").alias("origin_column"), F.lit(1).alias("impact_rank"), F.col("target").alias("impacted"), F.col("target_column").alias("impacted_column"),
        F.array(_label(F.col("source"), F.col("source_column")), _label(F.col("target"), F.col("target_column"))).alias("path"), F.lit(False).alias("is_cycle"),
    )


def _hashed(paths: DataFrame) -> DataFrame:
    return paths.withColumn("path_hash", F.sha2(F.array_join("path", " -> "), 256))


def _expand(level: DataFrame, e: DataFrame, max_rank: int, place: str, first: int = 1) -> DataFrame:
    """``level`` and all that extends it, each level written once below ``place`` and read by the next alone."""
    spark, number = e.sparkSession, first
    while True:
        path = f"{place}/level={number}"
        level.write.parquet(path)
        level = spark.read.schema(PATHS).parquet(path)
        if number - first >= max_rank or not level.limit(1).count():
            break
        number += 1
        level = extend(level.filter(~F.col("is_cycle") & (F.col("impact_rank") < max_rank)), steps_from(level.select(F.col("impacted").alias("object"), F.col("impacted_column").alias("column")).distinct(), e))
    return spark.read.schema(PATHS).option("basePath", place).parquet(f"{place}/*").drop("level")


def closure(edges: DataFrame, max_rank: int = 100) -> DataFrame:
    """(origin, origin_column, impact_rank, impacted, impacted_column, path, path_hash, is_cycle).

    ``edges`` has source, source_column, target, target_column and resolution_status.  A null
    column stands for all columns of its object.  A row whose target is on its path already is kept
    as a cycle and not followed.  Levels are tables of the shared folder.
    """
    spark = edges.sparkSession
    e, at = scratch.written(usable(edges), "edges")
    out = _expand(_first(e), e, max_rank, scratch.folder(spark, "closure"))
    scratch.forget(spark, at)
    return _hashed(out)


def steps_from(nodes: DataFrame, e: DataFrame) -> DataFrame:
    """(object, column, target, target_column): where edges lead from nodes.

    A null column on either side meets all columns; that is three equi-joins (equal, null edge, null node)
    rather than one with OR, which could only loop over all pairs.
    """
    n, c = nodes.alias("n"), e.alias("c")
    same = F.col("c.source") == F.col("n.object")
    joined = [
        n.join(c, same & (F.col("c.source_column") == F.col("n.column"))),
        n.join(c.filter("c.source_column IS NULL"), same),
        n.filter(F.col("column").isNull()).join(c.filter("c.source_column IS NOT NULL"), same),
    ]
    out = [j.select("n.object", "n.column", "c.target", "c.target_column") for j in joined]
    return out[0].unionByName(out[1]).unionByName(out[2]).distinct()


def extend(level: DataFrame, steps: DataFrame) -> DataFrame:
    """Paths one step longer."""
    p, s = level.alias("p"), steps.alias("s")
    to = _label(F.col("s.target"), F.col("s.target_column"))
    return p.join(s, (F.col("s.object") == F.col("p.impacted")) & F.col("s.column").eqNullSafe(F.col("p.impacted_column"))).select(
        "p.origin", "p.origin_column", (F.col("p.impact_rank") + 1).alias("impact_rank"), F.col("s.target").alias("impacted"), F.col("s.target_column").alias("impacted_column"),
        F.concat("p.path", F.array(to)).alias("path"), F.array_contains("p.path", to).alias("is_cycle"),
    )


def _targets(e: DataFrame) -> DataFrame:
    return e.select(F.col("target").alias("object"), F.col("target_column").alias("column")).distinct()


#: Parts the two labels of a step; no name has it.
BETWEEN = "\u0001"


def maintain(old: DataFrame, before: DataFrame, after: DataFrame, max_rank: int = 100) -> tuple[DataFrame, DataFrame]:
    """The closure of ``after`` from ``old``, that of ``before``; and the origins (origin, origin_column) whose rows differ.

    Paths with a step that no edge supports any more go, in one pass over ``old``.  A step may be supported by several
    edges (a column's own and its object's), so steps are compared rather than edges.  New paths are told apart by
    their first new step: it is a new edge from its origin, or follows a kept path.  These are the
    seeds; only they are expanded, over all edges, so rounds follow the longest new path and
    rows what changed.  ``old`` must have been made with the same ``max_rank``.
    """
    spark = old.sparkSession
    (b, at_b), (a, at_a) = scratch.written(usable(before), "before"), scratch.written(usable(after), "after")
    kept, gone, new = b.intersect(a), b.subtract(a), a.subtract(b)
    dead = steps_from(_targets(b), gone).subtract(steps_from(_targets(b), kept))
    made = steps_from(_targets(a), new).subtract(steps_from(_targets(a), kept))
    pair = lambda o, c, t, tc: F.concat(_label(F.col(o), F.col(c)), F.lit(BETWEEN), _label(F.col(t), F.col(tc)))
    # A first step comes from an edge of its own origin only, so it is told apart from the same step further on.
    ends = gone.select(F.concat(F.lit(BETWEEN), pair(*EDGE)).alias("step")).union(dead.select(pair("object", "column", "target", "target_column")))
    ends, at_ends = scratch.written(ends.distinct(), "ends")
    steps = F.expr(f"transform(sequence(2, size(path)), i -> concat(if(i = 2, '{BETWEEN}', ''), element_at(path, i - 1), '{BETWEEN}', element_at(path, i)))")
    broken = old.select("origin", "origin_column", "path_hash", F.explode(steps).alias("step")).join(ends, "step", "left_semi").select("origin", "origin_column", "path_hash").distinct()
    broken, at_broken = scratch.written(broken, "broken")
    place = scratch.folder(spark, "closure")
    names = [f.split(" ")[0] for f in PATHS.split(", ")]
    old.join(broken.select("path_hash"), "path_hash", "left_anti").select(*names).write.parquet(f"{place}/level=0")
    retained = spark.read.schema(PATHS).parquet(f"{place}/level=0")
    seeds = _first(new).unionByName(extend(retained.filter(~F.col("is_cycle") & (F.col("impact_rank") < max_rank)), made))
    out = _expand(seeds, a, max_rank, place)
    touched, _ = scratch.written(broken.select("origin", "origin_column").union(spark.read.schema(PATHS + ", level int").option("basePath", place).parquet(f"{place}/*").filter("level > 0").select("origin", "origin_column")).distinct(), "touched")
    scratch.forget(spark, at_b, at_a, at_ends, at_broken)
    return _hashed(out), touched


def usage_impact(usages: DataFrame, impact: DataFrame) -> DataFrame:
    """(origin, origin_column, object, usage_type, depth): usages of a column itself, and of all that it reaches."""
    own = usages.select(F.lower("source").alias("origin"), F.lower("source_column").alias("origin_column"), "object", "usage_type", F.lit(1).alias("depth"))
    u = usages.select(F.lower("source").alias("impacted"), F.lower("source_column").alias("impacted_column"), "object", "usage_type")
    reached = impact.join(u, ["impacted", "impacted_column"]).select("origin", "origin_column", "object", "usage_type", (F.col("impact_rank") + 1).alias("depth"))
    return own.unionByName(reached)


def impact_type(usage: Column) -> Column:
    return F.when(usage.isin(ROW_USAGES), "ROW_DEPENDENCY").when(usage.isin(VALUE_USAGES), "VALUE_DEPENDENCY").otherwise("UNKNOWN")


def report(impact: DataFrame, edges: DataFrame, origin: str, column: str | None = None) -> DataFrame:
    """What a column reaches, with the kind of the last edge and the path for display."""
    last = edges.select(F.lower("target").alias("impacted"), F.coalesce(F.lower("target_column"), F.lit("")).alias("_c"), "usage_type").distinct()
    x = impact.filter(F.col("origin") == origin.lower())
    if column:
        x = x.filter(F.col("origin_column") == column.lower())
    x = x.withColumn("_c", F.coalesce("impacted_column", F.lit(""))).join(last, ["impacted", "_c"], "left")
    return x.select("origin", "origin_column", "impact_rank", "impacted", "impacted_column", impact_type(F.col("usage_type")).alias("impact_type"), F.array_join("path", " → ").alias("path"), "is_cycle")
