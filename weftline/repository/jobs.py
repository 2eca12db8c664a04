"""The job side of collection: a registry of jobs, the tables that they make, and what stops running."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from weftline.functions.analysis import fingerprint_column, variables_column
from weftline.repository import registry

JOB_KEY = ["job_project", "job_id"]
TABLE = ["project_id", "dataset_id", "table_name"]
#: What a job registry holds of each job.
JOBS = "job_project string, job_id string, parent_job_id string, creation_time timestamp, user_email string, statement_type string, generation_type string, classification_reason string, label string, destination_project string, destination_dataset string, destination_table string, definition_text string, sql_fingerprint string, script_variables array<string>"


@dataclass
class Accounts:
    """Who makes tables: the label of schedules with their accounts, and the accounts of workflows."""

    label_key: str = "data_source_id"
    scheduled: list[str] = field(default_factory=list)
    dags: list[str] = field(default_factory=list)


def collect(log: DataFrame, old: DataFrame | None, accounts: Accounts, now: Column) -> DataFrame:
    """The job registry after a scan of the log: jobs of the lookback window that made tables, merged by project and id.

    A statement inside a script takes the variables that its parent declares.
    """
    spark = log.sparkSession
    old = old if old is not None else spark.createDataFrame([], JOBS)
    days = registry.lookback_days(old)
    recent = registry.usable_jobs(log).filter(F.col("creation_time") >= now - F.make_dt_interval(F.lit(days)))
    kind, reason = registry.classify(F.col("labels"), F.col("user_email"), accounts.label_key, accounts.scheduled, accounts.dags)
    made = recent.filter("statement_type <> 'SCRIPT'").withColumn("generation_type", kind).withColumn("classification_reason", reason).filter("generation_type IS NOT NULL")
    text = F.when(F.col("statement_type") == "CREATE_TABLE_AS_SELECT", registry.strip_create(F.col("query_text"))).otherwise(F.col("query_text"))
    scripts = recent.filter("statement_type = 'SCRIPT'").select("job_project", F.col("job_id").alias("parent_job_id"), variables_column("query_text").alias("script_variables"))
    made = made.withColumn("definition_text", text).withColumn("sql_fingerprint", F.sha2(fingerprint_column("definition_text"), 256)).withColumn("label", F.lower("generation_type"))
    new = made.join(scripts, ["job_project", "parent_job_id"], "left").select(*old.columns)
    return merge(old, new, JOB_KEY)


def merge(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both by key; what the new row does not know stays as it was."""
    both = old.select(*keys, F.struct(*old.columns).alias("_o")).join(registry.latest(new, keys, [F.desc("creation_time")]).select(*keys, F.struct(*old.columns).alias("_n")), keys, "full")
    return both.select(*[c if c in keys else F.coalesce(f"_n.{c}", f"_o.{c}").alias(c) for c in old.columns])


def generated(jobs: DataFrame, tables: DataFrame) -> DataFrame:
    """The latest definition of each generated table.

    A destination that exists and does not expire is its own object; of others each fingerprint is one.
    """
    there = tables.filter("expiration_timestamp IS NULL").select(*[F.lower(c).alias(n) for c, n in zip(TABLE, ("destination_project", "destination_dataset", "destination_table"), strict=True)]).distinct().withColumn("_there", F.lit(True))
    x = jobs.withColumns({c: F.lower(c) for c in ("destination_project", "destination_dataset", "destination_table")}).join(there, ["destination_project", "destination_dataset", "destination_table"], "left")
    lasts = F.coalesce("_there", F.lit(False))
    own = lambda real, made: F.when(lasts, F.col(real)).otherwise(made)
    x = x.select(
        own("destination_project", F.lower("job_project")).alias("object_project"), own("destination_dataset", F.col("label")).alias("object_dataset"), own("destination_table", F.concat(F.lit("fp_"), F.col("sql_fingerprint"))).alias("object_name"),
        F.lit("TABLE").alias("object_type"), "definition_text", F.when(lasts, F.sha2("definition_text", 256)).otherwise(F.col("sql_fingerprint")).alias("definition_hash"), "sql_fingerprint",
        (~lasts).alias("is_ephemeral"), "generation_type", "script_variables", F.col("job_id").alias("source_job_id"), F.col("creation_time").alias("last_seen_at"),
    )
    return registry.latest(x, registry.KEY, [F.desc("last_seen_at"), F.desc("source_job_id")])


def retire(definitions: DataFrame, tables: DataFrame, jobs: DataFrame, now: Column, days: int) -> DataFrame:
    """The registry without what no longer is: lasting tables that are gone or expire, fingerprints that no job of the window had."""
    made = F.col("generation_type").isin("SCHEDULED_QUERY", "DAG") & F.col("is_active")
    there = tables.filter("expiration_timestamp IS NULL").select(*[F.lower(c).alias(n) for c, n in zip(TABLE, registry.KEY, strict=False)]).distinct().withColumn("_there", F.lit(True))
    seen = jobs.filter(F.col("creation_time") >= now - F.make_dt_interval(F.lit(days))).select("sql_fingerprint").distinct().withColumn("_seen", F.lit(True))
    x = definitions.join(there, registry.KEY[:3], "left").join(seen, "sql_fingerprint", "left")
    ephemeral = F.coalesce("is_ephemeral", F.lit(False))
    status = F.when(made & ~ephemeral & F.col("_there").isNull(), "INACTIVE_OBJECT_NOT_FOUND").when(F.col("is_active") & ephemeral & F.col("_seen").isNull(), "INACTIVE_FINGERPRINT_NOT_SEEN")
    x = x.withColumn("_status", status)
    out = x.withColumns({"is_active": F.col("is_active") & F.col("_status").isNull(), "is_changed": F.col("is_changed") & F.col("_status").isNull(), "analysis_status": F.coalesce("_status", "analysis_status")})
    return out.select(*definitions.columns)
