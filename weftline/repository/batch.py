"""An analysis batch: what changed, with the columns it reads, to edges, usages and diagnostics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from weftline.functions.analysis import analyze_definitions, explode_result, shape_column, sources_column, unmasked
from weftline.sources import scratch

OBJECT = ["object_project", "object_dataset", "object_name", "object_type"]
MAX_METADATA = 900_000
#: Results of shapes are sent to all tasks if they were written in at most so many bytes.
BROADCAST_BYTES = 2 << 20


def changed(registry: DataFrame) -> DataFrame:
    return registry.filter(F.col("is_active") & F.col("is_changed") & F.col("definition_text").isNotNull())


def lookup_names(metadata: DataFrame) -> DataFrame:
    """Each table under its three names, so that matching is one equi-join instead of three OR-ed conditions."""
    p, d, t = F.lower("project_id"), F.lower("dataset_id"), F.lower("table_name")
    return metadata.withColumn("lookup", F.explode(F.array(F.concat_ws(".", p, d, t), F.concat_ws(".", d, t), t)))


def _known(tables: DataFrame, metadata: DataFrame) -> DataFrame:
    """Each table once, with whether it has column metadata."""
    name = ["project_id", "dataset_id", "table_name"]
    both = tables.select(*name, F.lit(False).alias("collected")).unionByName(metadata.select(*name, F.lit(True).alias("collected")))
    return both.groupBy(*name).agg(F.bool_or("collected").alias("collected"))


def match_names(names: DataFrame, known: DataFrame) -> DataFrame:
    """(name, project_id, dataset_id, table_name, collected): what each name stands for among known tables.

    A name of one to three parts meets the tables' three names, which is one equi-join.  A pattern with a star meets the
    names that begin with what it has before the star, an equi-join on the prefixes of the lengths that
    occur (at most as many as a name has characters), and stands for the latest table with columns of each dataset, or the latest.
    """
    names, table = names.select("name").distinct(), ["project_id", "dataset_id", "table_name"]
    tables = lookup_names(known)
    exact = names.join(tables.withColumnRenamed("lookup", "name"), "name").select("name", *table, "collected")
    quoted = F.transform(F.split("name", r"\*"), lambda x: F.concat(F.lit("\\Q"), x, F.lit("\\E")))
    p = names.filter(F.col("name").contains("*")).withColumn("_like", F.concat(F.lit("^"), F.array_join(quoted, ".*"), F.lit("$"))).withColumn("_prefix", F.substring_index("name", "*", 1))
    lengths = p.agg(F.collect_set(F.length("_prefix")).alias("_lengths"))  # one row
    prefixes = tables.crossJoin(F.broadcast(lengths)).select(*table, "collected", "lookup", F.explode("_lengths").alias("_n")).withColumn("_prefix", F.expr("left(lookup, _n)"))
    hit = p.join(prefixes, "_prefix").filter(F.rlike("lookup", F.col("_like")))
    shards = hit.groupBy("name", "project_id", "dataset_id").agg(F.max(F.struct("collected", "table_name")).alias("_t")).select("name", "project_id", "dataset_id", "_t.table_name", "_t.collected")
    return exact.unionByName(shards)


FIELDS = ["project_id", "dataset_id", "table_name", "column_name", "field_path", "ordinal_position"]


def with_sources(definitions: DataFrame, metadata: DataFrame | Callable[[DataFrame], DataFrame], tables: DataFrame | None = None, key: list[str] = OBJECT, masked: str | None = None) -> DataFrame:
    """Definitions (identified by ``key``) with what their statements read, each statement read once.

    ``metadata`` is a table, or a function that reads it for the datasets (project_id, dataset_id) that statements name; it then
    needs ``tables``.

    ``referenced`` has the names of its sources (null: it cannot be told), ``columns`` their ordered metadata, ``metadata_bytes``
    its size; ``has_absent_source`` says that a source is not among ``tables`` (if not given, those with metadata), and
    ``has_uncollected_source`` that one is there without metadata.
    """
    spark = definitions.sparkSession
    refs, _ = scratch.written(definitions.select(*key, sources_column("definition_text", masked).alias("referenced")), "sources")
    named = refs.select(*key, F.explode("referenced").alias("name")).distinct()
    if callable(metadata):
        named_in, _ = scratch.written(match_names(named, _known(tables, tables)).select("project_id", "dataset_id").distinct(), "datasets")
        metadata, _ = scratch.written(metadata(named_in), "metadata")
    known = _known(tables if tables is not None else metadata, metadata)
    hits, _ = scratch.written(match_names(named, known), "matches")
    state = hits.groupBy("name").agg(F.bool_or("collected").alias("collected"))
    flags = named.join(state, "name", "left").groupBy(*key).agg(F.bool_or(F.col("collected").isNull()).alias("has_absent_source"), F.bool_or(~F.col("collected")).alias("has_uncollected_source"))
    flags = flags.withColumn("has_uncollected_source", F.coalesce("has_uncollected_source", F.lit(False)))
    # Only tables that statements name are read from the metadata; a shard's columns go under the last part of its pattern.
    own = hits.filter("collected").withColumn("_as", F.when(F.col("name").contains("*"), F.substring_index("name", ".", -1)))
    cols = metadata.select(*FIELDS).join(own, ["project_id", "dataset_id", "table_name"]).withColumn("table_name", F.coalesce("_as", "table_name"))
    cols = named.join(cols, "name").select(*key, F.struct("ordinal_position", *[c for c in FIELDS if c != "ordinal_position"]).alias("c"))
    cols = cols.groupBy(*key).agg(F.array_sort(F.collect_set("c")).alias("c")).withColumn("columns", F.transform("c", lambda x: F.struct(*[x[f].alias(f) for f in FIELDS]))).drop("c")
    out = definitions.join(refs, key, "left").join(flags, key, "left").join(cols, key, "left")
    return out.withColumn("metadata_bytes", F.coalesce(F.octet_length(F.to_json("columns")), F.lit(0)))


def run(definitions: DataFrame, metadata: DataFrame | Callable[[DataFrame], DataFrame], variables: str | None = None, tables: DataFrame | None = None, max_metadata: int = MAX_METADATA) -> DataFrame:
    """Analyzed definitions with ``failure_stage`` and the flags of their sources.

    Statements that differ in literal numbers only have one shape, which is analysed once for all of them; each definition
    then gets its shape's results, with its own numbers in them.

    A statement whose sources cannot be told is marked SOURCE_DISCOVERY; one with more metadata
    than a statement may have METADATA_TOO_LARGE, and is not analysed.
    """
    shaped = definitions.withColumn("_shape", shape_column("definition_text")).withColumns({"_text": F.col("_shape.shape"), "_numbers": F.col("_shape.numbers"), "_masked": F.col("_shape.numbers") != "", "_variables": F.col(variables) if variables else F.array().cast("array<string>")}).drop("_shape")
    shapes = ["_text", "_masked", "_variables"]
    d, _ = scratch.written(shaped.select(*shapes).distinct().withColumn("_id", F.monotonically_increasing_id()).withColumnRenamed("_text", "definition_text"), "shapes")
    d = with_sources(d, metadata, tables, ["_id"], "_masked")
    stage = F.when(F.col("definition_text").isNotNull() & F.col("referenced").isNull(), "SOURCE_DISCOVERY").when(F.col("metadata_bytes") >= max_metadata, "METADATA_TOO_LARGE")
    large = F.coalesce(F.col("failure_stage") == "METADATA_TOO_LARGE", F.lit(False))
    d = d.withColumn("failure_stage", stage).withColumn("_sql", F.when(~large, F.col("definition_text"))).withColumn("columns", F.when(~large, F.col("columns")))
    d = analyze_definitions(d, sql="_sql", variables="_variables", masked="_masked").drop("_sql", "_id")
    d, at = scratch.written(d.withColumnsRenamed({"definition_text": "_s_text", "_masked": "_s_masked", "_variables": "_s_variables"}), "results")
    d = F.broadcast(d) if scratch.size_of(d.sparkSession, at) <= BROADCAST_BYTES else d.hint("merge")
    same = [F.col(c).eqNullSafe(F.col(c.replace("_", "_s_", 1))) for c in shapes]
    out = shaped.join(d, same[0] & same[1] & same[2], "left")
    return out.withColumn("result", unmasked(F.col("result"), F.col("_numbers"))).drop(*shapes, *[c.replace("_", "_s_", 1) for c in shapes], "_numbers")


def publishable(analyzed: DataFrame) -> Column:
    """Complete, or with warnings while no source is there whose columns were not collected; sources that are absent do no harm."""
    uncollected = F.coalesce("has_uncollected_source", F.lit(False)) if "has_uncollected_source" in analyzed.columns else F.lit(False)
    stage = F.col("failure_stage").isNull() if "failure_stage" in analyzed.columns else F.lit(True)
    return stage & ((F.col("result.status") == "COMPLETED") | ((F.col("result.status") == "COMPLETED_WITH_WARNINGS") & ~uncollected))


def _parts(name: Column, project: Column, dataset: Column) -> list[Column]:
    """Project, dataset and table of a name of one to three parts, defaults filled in."""
    p = F.split(F.lower(name), r"\.")
    n = F.size(p)
    return [F.when(n >= 3, F.get(p, n - 3)).otherwise(project), F.when(n >= 2, F.get(p, n - 2)).otherwise(dataset), F.get(p, n - 1)]


def edge_key(*cols: Column) -> Column:
    return F.sha2(F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in cols]), 256)


def edges(analyzed: DataFrame, views: DataFrame | None = None) -> DataFrame:
    """Direct dependencies: one row per source column and output column of a publishable definition."""
    x = explode_result(analyzed.filter(publishable(analyzed)), "paths")
    p, d, o = _parts(F.col("table"), F.col("object_project"), F.col("object_dataset"))
    x = x.select(
        p.alias("source_project"), d.alias("source_dataset"), o.alias("source_object"), F.lower(F.coalesce("field_path", "column_name")).alias("source_column"),
        F.col("object_project").alias("target_project"), F.col("object_dataset").alias("target_dataset"), F.col("object_name").alias("target_object"), F.col("object_type").alias("target_object_type"), F.lower("output").alias("target_column"),
        F.lit("VALUE").alias("dependency_type"), F.col("lineage_status").alias("resolution_status"),
    ).distinct()
    if views is not None:
        v = views.select(F.col("object_project").alias("source_project"), F.col("object_dataset").alias("source_dataset"), F.col("object_name").alias("source_object"), F.lit("VIEW").alias("_t")).distinct()
        x = x.join(v, ["source_project", "source_dataset", "source_object"], "left").withColumn("source_object_type", F.coalesce("_t", F.lit("TABLE"))).drop("_t")
    else:
        x = x.withColumn("source_object_type", F.lit("TABLE"))
    star = lambda c: F.coalesce(F.col(c), F.lit("*"))
    return x.withColumn("edge_key", edge_key(F.col("source_project"), F.col("source_dataset"), F.col("source_object"), star("source_column"), F.col("target_project"), F.col("target_dataset"), F.col("target_object"), star("target_column"), F.col("target_object_type")))


def usages(analyzed: DataFrame) -> DataFrame:
    x = explode_result(analyzed.filter(publishable(analyzed)), "usages")
    p, d, o = _parts(F.col("table"), F.col("object_project"), F.col("object_dataset"))
    x = x.select(*OBJECT, p.alias("source_project"), d.alias("source_dataset"), o.alias("source_object"), F.lower(F.coalesce("field_path", "column_name")).alias("source_column"), "usage_type", "reference_name", "line", "column", "line_text").distinct()
    place = [F.coalesce(F.col(c), F.lit(-1)).cast("string") for c in ("line", "column")]
    return x.withColumn("usage_key", edge_key(*[F.col(c) for c in (*OBJECT, "source_project", "source_dataset", "source_object", "source_column", "usage_type")], *place, F.col("reference_name")))


def diagnostics(analyzed: DataFrame) -> DataFrame:
    """Diagnostics of definitions that are not published, and one that says why: where the analysis stopped, or its status."""
    bad = analyzed.filter(~publishable(analyzed))
    none = F.lit(None).cast("int")
    object_ = F.concat_ws(".", *OBJECT[:3])
    text = F.format_string("status %s", F.col("result.status"))
    if "failure_stage" in analyzed.columns:
        size = F.format_string("%s reads tables with %d bytes of column metadata, more than a statement may have", object_, F.col("metadata_bytes")) if "metadata_bytes" in analyzed.columns else object_
        text = F.when(F.col("failure_stage") == "SOURCE_DISCOVERY", F.format_string("the sources of %s cannot be told", object_)).when(F.col("failure_stage") == "METADATA_TOO_LARGE", size).otherwise(text)
    said = F.struct(F.lit("ERROR").alias("severity"), F.lit("UDF_RESULT_NOT_PUBLISHABLE").alias("code"), none.alias("line"), none.alias("column"), text.alias("message"))
    # One row each, so that the definitions are gone through once.
    return bad.select(*OBJECT, F.explode(F.concat("result.diagnostics", F.array(said))).alias("_x")).select(*OBJECT, "_x.*")


def publish(old: DataFrame, new: DataFrame, analyzed: DataFrame) -> DataFrame:
    """Edges after a batch: those of objects analysed and publishable are replaced, all others (failed ones too) stay."""
    done = analyzed.filter(publishable(analyzed)).select(F.col("object_project").alias("target_project"), F.col("object_dataset").alias("target_dataset"), F.col("object_name").alias("target_object")).distinct()
    return old.join(done, ["target_project", "target_dataset", "target_object"], "left_anti").unionByName(new)


def without_orphans(edges_: DataFrame, usages_: DataFrame, registry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges and usages of objects that are in the registry and active."""
    live = registry.filter("is_active").select(*OBJECT).distinct()
    targets = live.select(*[F.col(c).alias(c.replace("object", "target", 1)) for c in OBJECT[:2]], F.col("object_name").alias("target_object")).distinct()
    return edges_.join(targets, targets.columns, "left_semi"), usages_.join(live, OBJECT, "left_semi")
