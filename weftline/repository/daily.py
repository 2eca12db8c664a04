"""The daily run: collect, analyse what changed, bring edges, usages and impact up to date, report, publish."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weftline.functions.analysis import explode_result
from weftline.repository import batch, impact, jobs as job_side, registry, reports, store
from weftline.sources import catalog, scratch

REGISTRY = "object_project string, object_dataset string, object_name string, object_type string, definition_text string, definition_hash string, previous_definition_hash string, is_changed boolean, is_active boolean, analysis_status string, last_analyzed_hash string, last_seen_at timestamp, is_ephemeral boolean, sql_fingerprint string, generation_type string, script_variables array<string>, source_job_id string"
KEY = registry.KEY


@dataclass
class Snapshot:
    """All tables of the repository after a run, and what the run did."""

    registry: DataFrame
    edges: DataFrame
    usages: DataFrame
    diagnostics: DataFrame
    impact: DataFrame
    unanalyzed: DataFrame
    jobs: DataFrame | None = None
    #: Counters of the analysis (``reports.counters``), observed while it was written.
    summary: dict = field(default_factory=dict)
    #: Objects whose edges and usages the run replaced or took away, and origins whose impact changed (None: all).
    replaced: DataFrame | None = None
    moved: DataFrame | None = None


@dataclass
class Gate:
    """Patterns of dataset and object names, each a list to include (empty: all) and one to exclude."""

    include: list[str] = field(default_factory=list)
    exclude: list[str] = field(default_factory=list)
    include_objects: list[str] = field(default_factory=list)
    exclude_objects: list[str] = field(default_factory=list)

    def datasets(self, c: str = "object_dataset") -> Column:
        return registry.matches(F.col(c), self.include, self.exclude)

    def objects(self, c: str = "object_name") -> Column:
        return registry.matches(F.col(c), self.include_objects, self.exclude_objects)


def collect(views: DataFrame, before: Snapshot | None = None, gate: Gate | None = None, log: DataFrame | None = None, tables: DataFrame | None = None, accounts: job_side.Accounts | None = None) -> tuple[DataFrame, DataFrame | None]:
    """The registries of definitions and jobs after a scan.

    Views of datasets that the gate lets through and the scan lacks, or whose own name the gate stops, go out of
    service; those of other datasets were not looked at and stay.
    """
    spark = views.sparkSession
    gate = gate or Gate()
    scan = registry.scan_definitions(views.filter(gate.datasets() & gate.objects())).withColumn("last_seen_at", F.current_timestamp())
    old = before.registry if before else spark.createDataFrame([], REGISTRY)
    by_jobs = F.col("generation_type").isNotNull()
    seen = registry.upsert(old, scan)
    reg, known_jobs = registry.deactivate_missing(seen.filter(~by_jobs), scan, gate.datasets() & (F.col("object_type") == "VIEW")), before.jobs if before else None
    if log is None:
        return reg.unionByName(seen.filter(by_jobs)).checkpoint(), known_jobs
    now, days = F.current_timestamp(), registry.lookback_days(known_jobs) if known_jobs is not None else registry.lookback_days(spark.createDataFrame([], job_side.JOBS))
    known_jobs = job_side.collect(log, known_jobs, accounts or job_side.Accounts(), now).checkpoint()
    recent = known_jobs.filter(F.col("creation_time") >= now - F.make_dt_interval(F.lit(days)))
    made = registry.upsert(seen.filter(by_jobs), job_side.generated(recent, tables))
    return reg.unionByName(job_side.retire(made, tables, known_jobs, now, days)).checkpoint(), known_jobs


def _graph(edges: DataFrame) -> DataFrame:
    name = lambda side: F.concat_ws(".", f"{side}_project", f"{side}_dataset", f"{side}_object")
    return edges.select(name("source").alias("source"), "source_column", name("target").alias("target"), "target_column", "resolution_status")


def analyze(reg: DataFrame, metadata: DataFrame, before: Snapshot | None = None, max_rank: int = 100, tables: DataFrame | None = None, known_jobs: DataFrame | None = None, only: Column | None = None) -> Snapshot:
    """Analyse the changed definitions of a registry (those of ``only``) and replace their edges, usages and impact.

    What cannot be published leaves the object's old edges and usages in place and marks it FAILED; those
    of inactive objects go.  The impact closure is kept up to date from the edges that changed.
    """
    todo = batch.changed(reg) if only is None else batch.changed(reg).filter(only)
    keep = [*KEY, "definition_text", "definition_hash", "result", "failure_stage", "metadata_bytes", "has_absent_source", "has_uncollected_source"]
    with scratch.passing(reg.sparkSession) as stays:
        analyzed, summary = reports.counted(batch.run(todo, metadata, "script_variables", tables).select(*keep))
        stays(analyzed)
    ok = batch.publishable(analyzed)
    done = analyzed.select(*KEY, F.col("definition_hash").alias("_hash"), ok.alias("_ok"))
    reg = reg.join(done, KEY, "left")
    tried, fine = F.col("_ok").isNotNull(), F.coalesce("_ok", F.lit(False))
    reg = reg.withColumns({
        "analysis_status": F.when(fine, "COMPLETED").when(tried, "FAILED").otherwise(F.col("analysis_status")),
        "last_analyzed_hash": F.when(fine, F.col("_hash")).otherwise(F.col("last_analyzed_hash")),
        "is_changed": F.col("is_changed") & ~fine,
    }).drop("_hash", "_ok").checkpoint()
    good = analyzed.filter(ok)
    edges, usages = batch.edges(good, reg), batch.usages(good)
    if before:
        edges = batch.publish(before.edges, edges, good)
        usages = before.usages.join(good.select(*KEY).distinct(), KEY, "left_anti").unionByName(usages)
    edges, usages = batch.without_orphans(edges, usages, reg)
    edges, usages = edges.checkpoint(), usages.checkpoint()
    dead = reg.filter("NOT is_active").select(*KEY)
    replaced = good.select(*KEY).union(dead).distinct() if before else None
    if before is None:
        closure, moved = impact.closure(_graph(edges), max_rank), None
    else:
        closure, moved = impact.maintain(before.impact, _graph(before.edges), _graph(edges), max_rank)
    return Snapshot(reg, edges, usages, batch.diagnostics(analyzed), closure, reports.unanalyzed(reg), known_jobs, summary, replaced, moved)


def run(views: DataFrame, metadata: DataFrame, before: Snapshot | None = None, gate: Gate | None = None, max_rank: int = 100, log: DataFrame | None = None, tables: DataFrame | None = None, accounts: job_side.Accounts | None = None) -> Snapshot:
    """One run over the scanned views (identity, definition_text) and, with a job ``log``, over the tables that jobs make.

    ``tables`` are those that exist (project_id, dataset_id, table_name, expiration_timestamp); a log needs them.
    Only definitions whose text changed are analysed.  ``max_rank`` is that of the run before.
    """
    impact.ready(views.sparkSession)
    reg, known_jobs = collect(views, before, gate, log, tables, accounts)
    return analyze(reg, metadata, before, max_rank, tables, known_jobs)


def run_catalog(spark: SparkSession, root: str, before: Snapshot | None = None, gate: Gate | None = None, sources: Gate | None = None, max_rank: int = 100, log: DataFrame | None = None, accounts: job_side.Accounts | None = None) -> Snapshot:
    """A run over a catalog: views of the datasets of ``gate``, tables of those of ``sources``, and columns only of datasets that changed statements name."""
    tables = catalog.read(spark, root, "tables").filter((sources or Gate()).datasets("dataset_id"))
    return run(catalog.read(spark, root, "views"), lambda datasets: catalog.referenced_columns(spark, root, datasets), before, gate, max_rank, log, scratch.written(tables, "tables")[0], accounts)


def analyze_changed(before: Snapshot, metadata: DataFrame, max_rank: int = 100, tables: DataFrame | None = None, only: Column | None = None) -> Snapshot:
    """A run without a scan: what the registry has as changed, or of that the objects that ``only`` names (a single view)."""
    impact.ready(metadata.sparkSession)
    return analyze(before.registry, metadata, before, max_rank, tables, before.jobs, only)


def inspect(definition: DataFrame, metadata: DataFrame, tables: DataFrame | None = None) -> dict[str, DataFrame]:
    """Definitions analysed for a look, nothing published: status, diagnostics, outputs and paths."""
    with scratch.passing(definition.sparkSession) as stays:
        a = stays(reports.counted(batch.run(definition, metadata, None, tables), "look")[0])
    status = a.select(*KEY, F.col("result.status").alias("status"), "failure_stage", batch.publishable(a).alias("is_publishable"), *[F.size(f"result.{p}").alias(f"n_{p}") for p in ("outputs", "paths", "usages", "diagnostics")])
    return {"status": status} | {p: explode_result(a.select(*KEY, "result"), p) for p in ("diagnostics", "outputs", "paths")}


#: The tables that a store has, with the columns that name an object of each; their types are those of the first run.
STORED = {"registry": KEY, "edges": ["target_project", "target_dataset", "target_object"], "usages": KEY, "diagnostics": KEY, "impact": ["origin"]}


def open_store(spark: SparkSession, root: str, like: Snapshot) -> store.Store:
    schema = lambda df: ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return store.Store(spark, root, {n: store.Table(schema(getattr(like, n)), keys) for n, keys in STORED.items()})


def load(at: store.Store) -> Snapshot:
    """The published tables."""
    reg = at.read("registry")
    return Snapshot(reg, at.read("edges"), at.read("usages"), at.read("diagnostics"), at.read("impact"), reports.unanalyzed(reg))


def publish(after: Snapshot, at: store.Store, step=lambda what: None) -> int:
    """Make a run's tables current, all at once; edges, usages and impact only where the run changed them."""
    if after.replaced is None or not at.version():
        changes = {n: store.Replace(getattr(after, n)) for n in STORED}
        return at.publish(changes, step)
    targets = after.replaced.select(*[F.col(k).alias(t) for k, t in zip(KEY[:3], STORED["edges"], strict=True)]).distinct()
    origins = after.moved.select("origin").distinct()
    part = lambda df, objects: store.Replace(df.join(objects, objects.columns, "left_semi"), objects)
    return at.publish({"registry": store.Replace(after.registry), "edges": part(after.edges, targets), "usages": part(after.usages, after.replaced), "diagnostics": store.Replace(after.diagnostics), "impact": part(after.impact, origins)}, step)
