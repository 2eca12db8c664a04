"""Coverage, access and run reports."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from weftline.repository import batch
from weftline.sources import scratch


def covered(status: Column, last_hash: Column, now_hash: Column) -> Column:
    return F.coalesce(status.isin("COMPLETED", "COMPLETED_WITH_WARNINGS"), F.lit(False)) & last_hash.eqNullSafe(now_hash)


def unanalyzed(registry: DataFrame) -> DataFrame:
    """Active lasting definitions that no analysis covers, with the reason; the latest of each hash."""
    c = covered(F.col("analysis_status"), F.col("last_analyzed_hash"), F.col("definition_hash"))
    reason = F.when(F.col("analysis_status").isNull(), "NOT_ANALYZED").when(~F.col("last_analyzed_hash").eqNullSafe(F.col("definition_hash")), "DEFINITION_CHANGED").otherwise(F.col("analysis_status"))
    x = registry.filter("is_active AND NOT coalesce(is_ephemeral, false)").filter(~c).withColumn("coverage_reason", reason)
    w = Window.partitionBy("definition_hash").orderBy(F.desc("last_seen_at"), "object_name")
    return x.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


#: What a coverage report says of each object.
GAP = "object_project string, object_dataset string, object_name string, object_type string, coverage_reason string"


def coverage_gaps(registry: DataFrame, existing: DataFrame, made: DataFrame | None = None) -> DataFrame:
    """Objects that exist and that no analysis covers: registered ones with their reason, others as NOT_REGISTERED.

    ``existing`` are the views and tables of a fresh scan (project_id, dataset_id, table_name, table_type); a base table counts only
    if a job of ``made`` (destination_project, destination_dataset, destination_table) wrote it, then as GENERATED_TABLE.
    """
    names = [f.split(" ")[0] for f in GAP.split(", ")]
    there = existing.select(F.lower("project_id").alias("object_project"), F.lower("dataset_id").alias("object_dataset"), F.lower("table_name").alias("object_name"), F.upper("table_type").alias("_type")).distinct()
    views = there.filter("_type = 'VIEW'").select(*names[:3], F.lit("VIEW").alias("object_type"))
    if made is not None:
        own = made.select(*[F.lower(f"destination_{c}").alias(f"object_{n}") for c, n in (("project", "project"), ("dataset", "dataset"), ("table", "name"))]).distinct()
        views = views.unionByName(there.filter("_type = 'BASE TABLE'").join(own, names[:3], "left_semi").select(*names[:3], F.lit("GENERATED_TABLE").alias("object_type")))
    kind = F.when(F.col("object_type") == "TABLE", "GENERATED_TABLE").otherwise(F.col("object_type")).alias("object_type")
    known = registry.filter("is_active").select(*names[:3], kind).distinct()
    new = views.join(known, names[:4], "left_anti").withColumn("coverage_reason", F.lit("NOT_REGISTERED"))
    # Registered definitions count while their object is still there.
    return unanalyzed(registry).select(*names[:3], kind, "coverage_reason").join(views, names[:4], "left_semi").unionByName(new)


def view_access(log: DataFrame, views: Column, ts: str = "ts", user: str = "user", now: Column | None = None, days: int = 180) -> DataFrame:
    """Of each view (path a/project/b/dataset/c/view) in an audit log: last access, its user, accesses, users; with ``now`` in the ``days`` before it."""
    log = log if now is None else log.filter(F.col(ts) >= now - F.make_dt_interval(F.lit(days)))
    x = log.withColumn("_v", F.explode(views)).withColumn("_p", F.split("_v", "/"))
    x = x.select(F.get("_p", F.lit(1)).alias("project"), F.get("_p", F.lit(3)).alias("dataset"), F.get("_p", F.lit(5)).alias("view_name"), ts, user)
    return x.groupBy("project", "dataset", "view_name").agg(F.max(ts).alias("last_accessed_at"), F.count(F.lit(1)).alias("query_count"), F.countDistinct(user).alias("distinct_users"), F.max_by(user, F.struct(ts, user)).alias("latest_user"))


def last_access(registry: DataFrame, access: DataFrame, today: Column) -> DataFrame:
    """Active views with their last access and the days since; never accessed ones last."""
    v = registry.filter("is_active AND object_type = 'VIEW'").select(F.col("object_project").alias("project"), F.col("object_dataset").alias("dataset"), F.col("object_name").alias("view_name"))
    x = v.join(access, ["project", "dataset", "view_name"], "left")
    return x.withColumn("days_since", F.datediff(today, F.col("last_accessed_at"))).orderBy(F.desc_nulls_last("last_accessed_at"), "view_name")


def counters() -> list[Column]:
    """What a run counts of its analyzed definitions, for ``observe`` while they are written or for ``agg``."""
    s = F.col("result.status")
    count = lambda cond, name: F.count(F.when(cond, 1)).alias(name)
    return [
        F.count(F.lit(1)).alias("definitions"), count(s == "COMPLETED", "completed"), count(s == "COMPLETED_WITH_WARNINGS", "with_warnings"), count(s == "COMPLETED_WITH_ERRORS", "with_errors"), count(s == "PARTIAL_FAILURE", "failed"),
        F.coalesce(F.sum(F.size("result.paths")), F.lit(0)).alias("paths"), F.coalesce(F.sum(F.size("result.usages")), F.lit(0)).alias("usages"), F.coalesce(F.sum(F.octet_length("definition_text")), F.lit(0)).alias("text_bytes"),
    ]


def run_summary(analyzed: DataFrame) -> DataFrame:
    return analyzed.agg(*counters())


def counted(analyzed: DataFrame, name: str = "analyzed") -> tuple[DataFrame, dict]:
    """``analyzed`` written once, and its counters, observed as it was written, with the seconds that took and the bytes written."""
    spark, seen, began = analyzed.sparkSession, Observation(), time.monotonic()
    out, at = scratch.written(analyzed.observe(seen, *counters()), name)
    return out, seen.get | {"seconds": time.monotonic() - began, "written_bytes": scratch.size_of(spark, at)}


def non_completed(analyzed: DataFrame) -> DataFrame:
    """The closing result of a run: diagnostics of all definitions that did not complete, worst first."""
    x = batch.diagnostics(analyzed)
    rank = F.element_at(F.create_map(*[F.lit(v) for kv in (("ERROR", 3), ("WARNING", 2), ("INFO", 1)) for v in kv]), F.col("severity"))
    return x.orderBy(F.desc_nulls_last(rank), *batch.OBJECT, "code", F.asc_nulls_last("line"), F.asc_nulls_last("column"))


def validate(checks: dict[str, DataFrame]) -> DataFrame:
    """(check, violations, verdict) of named DataFrames that should be empty, and the verdict of all."""
    rows = None
    for name, df in checks.items():
        one = df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check"), "violations")
        rows = one if rows is None else rows.unionByName(one)
    rows = rows.withColumn("verdict", F.when(F.col("violations") == 0, "PASS").otherwise("FAIL"))
    total = rows.agg(F.sum("violations").alias("violations")).select(F.lit("overall").alias("check"), "violations", F.when(F.col("violations") == 0, "PASS").otherwise("FAIL").alias("verdict"))
    return rows.unionByName(total)


def render(template: str, values: dict[str, str]) -> str:
    """A statement with its ``__NAME__`` placeholders filled; a placeholder left over is an error."""
    import re

    for k, v in values.items():
        template = template.replace(f"__{k}__", v)
    if left := re.findall(r"__[A-Z_]+__", template):
        raise ValueError(f"placeholders without a value: {sorted(set(left))}")
    return template
