"""Registries of definitions and jobs: collection, change detection, upserts as snapshot joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

KEY = ["object_project", "object_dataset", "object_name", "object_type"]


def matches(c: Column, include: list[str], exclude: list[str]) -> Column:
    """Case-insensitive partial match of any include pattern (none: all) and of no exclude pattern."""
    low = F.lower(c)
    hit = F.lit(not include)
    for p in include:
        hit = hit | low.rlike(p.lower())
    for p in exclude:
        hit = hit & ~low.rlike(p.lower())
    return hit


def scan_definitions(views: DataFrame, text: str = "definition_text") -> DataFrame:
    """Definitions with text, names in lower case, and the hash that tells changes."""
    v = views.filter(F.length(F.trim(text)) > 0)
    return v.withColumns({k: F.lower(k) for k in KEY[:3]}).withColumn("definition_hash", F.sha2(text, 256))


def lookback_days(jobs: DataFrame, first: int = 60, later: int = 3) -> int:
    return later if jobs.limit(1).count() else first


def upsert(old: DataFrame, new: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """The registry after a scan: full outer join on the keys.

    A changed hash moves to previous_definition_hash, clears analysis_status and sets is_changed,
    which stays set until an analysis clears it; an object that comes back is changed too, since its edges
    went with it; what the scan lacks stays as it is.
    """
    o = old.select(*keys, *[F.col(c).alias(f"_o_{c}") for c in old.columns if c not in keys])
    n = new.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in new.columns if c not in keys])
    x = o.join(n, keys, "full")
    seen, known = F.col("_n_definition_hash").isNotNull(), F.col("_o_definition_hash").isNotNull()
    moved = seen & known & (F.col("_n_definition_hash") != F.col("_o_definition_hash"))
    back = seen & known & ~F.coalesce("_o_is_active", F.lit(True))
    special = {
        "previous_definition_hash": F.when(moved, F.col("_o_definition_hash")).otherwise(F.col("_o_previous_definition_hash")),
        "is_changed": F.coalesce("_o_is_changed", F.lit(False)) | moved | back | (seen & ~known),
        "is_active": F.when(seen, True).otherwise(F.coalesce("_o_is_active", F.lit(True))),
        "analysis_status": F.when(moved | back | (seen & ~known), None).otherwise(F.col("_o_analysis_status")),
    }

    def pick(c: str) -> Column:
        if c in special:
            return special[c]
        return F.coalesce(f"_n_{c}", f"_o_{c}") if c in new.columns else F.col(f"_o_{c}")

    return x.select(*keys, *[pick(c).alias(c) for c in old.columns if c not in keys])


def deactivate_missing(registry: DataFrame, scan: DataFrame, scope: Column, keys: list[str] = KEY, status: str = "INACTIVE_OBJECT_NOT_FOUND") -> DataFrame:
    """Active objects of ``scope`` (what the scan looked at) that the scan lacks go out of service; all others stay as they are."""
    gone = registry.join(scan.select(*keys).distinct().withColumn("_found", F.lit(True)), keys, "left")
    gone = gone.withColumn("_gone", F.coalesce(F.col("is_active") & F.col("_found").isNull() & scope, F.lit(False)))
    new = {"is_active": F.col("is_active") & ~F.col("_gone"), "is_changed": F.col("is_changed") & ~F.col("_gone"), "analysis_status": F.when(F.col("_gone"), status).otherwise(F.col("analysis_status"))}
    return gone.withColumns(new).select(*registry.columns)


def usable_jobs(jobs: DataFrame) -> DataFrame:
    """Finished queries without error that made a table, or scripts."""
    made = F.col("destination_table").isNotNull() & F.col("statement_type").isin("SELECT", "CREATE_TABLE_AS_SELECT")
    return jobs.filter((F.col("job_type") == "QUERY") & (F.col("state") == "DONE") & F.col("error_reason").isNull() & F.col("query_text").isNotNull() & (made | (F.col("statement_type") == "SCRIPT")))


def classify(labels: Column, email: Column, label_key: str, accounts: list[str], dag_accounts: list[str]) -> tuple[Column, Column]:
    """generation_type and the reason; a schedule's label with its account wins over a DAG account."""
    scheduled = F.coalesce(F.exists(labels, lambda x: x["key"] == label_key), F.lit(False)) & email.isin(accounts)
    kind = F.when(scheduled, "SCHEDULED_QUERY").when(email.isin(dag_accounts), "DAG")
    return kind, F.when(scheduled, "LABEL_AND_ACCOUNT").when(email.isin(dag_accounts), "USER_EMAIL")


#: What a head may have between its words: quoted text and comments are whole, so that no AS in them ends it.
_PIECE = r"""(?:'(?:[^'\\]|\\.)*+'|"(?:[^"\\]|\\.)*+"|`[^`]*+`|--[^\n]*+|/\*.*?\*/|[^'"`aA/-]++|[aA/-])"""


def strip_create(text: Column) -> Column:
    """The query of a CREATE TABLE ... AS statement; other statements, and heads of over 500 pieces, as they are."""
    head = r"(?is)^\s*CREATE\s+(?:OR\s+REPLACE\s+)?(?:TEMP(?:ORARY)?\s+)?TABLE\s+" + _PIECE + r"{1,500}?\bAS\b\s*(?=\(|WITH\b|SELECT\b)"
    return F.regexp_replace(text, head, "")


def latest(df: DataFrame, by: list, order: list) -> DataFrame:
    """The first row of each group by ``order``; one shuffle by the group, of which Spark keeps the top row only."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")
