"""Readers and writers: Parquet tables, sharded tables, JSON collections, catalog metadata."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from weftline.sources.scratch import file_system

TABLES = "region nation customer supplier part orders lineitem events embeddings labels conversations benchmark pages documents".split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str, names: Iterable[str] = TABLES[:8]) -> None:
    """Temporary views, each a lazy Parquet scan: columns and filters are pushed down by what the query needs."""
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(n)


def sharded(spark: SparkSession, pattern: str, where: str = "true") -> DataFrame:
    """Tables that match a path pattern as one, with ``_TABLE_SUFFIX``: what the pattern's star stood for.

    ``where`` is a predicate on _TABLE_SUFFIX.  It is applied to the names of the shards (one listing of their folder), so
    those that it leaves out are not listed further, opened or planned.  Columns are those of the latest shard that is left;
    older shards have nulls for what they lack.
    """
    prefix, _, end = pattern.split("/")[-1].partition("*")
    fs, p = file_system(spark, pattern)
    found = [str(s.getPath()) for s in fs.globStatus(p) or []]
    suffix = {x: x.split("/")[-1][len(prefix) : -len(end) or None] for x in found}
    names = spark.createDataFrame(list(suffix.items()), "path string, _TABLE_SUFFIX string").filter(where)
    paths = sorted((r.path for r in names.collect()), key=suffix.get)  # one row a shard
    if not paths:
        return spark.createDataFrame([], "_TABLE_SUFFIX string")
    schema = spark.read.parquet(paths[-1]).schema
    out = None
    # Shards are Parquet tables apart, so a suffix is a constant of its scan.
    for path in paths:
        one = spark.read.schema(schema).parquet(path).withColumn("_TABLE_SUFFIX", F.lit(suffix[path]))
        out = one if out is None else out.unionByName(one)
    return out


def json_collection(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A collection of JSON objects, one a line or in arrays over several lines; what a row lacks is null."""
    return spark.read.option("multiLine", True).schema(schema).json(path)


def columns_of(schema: T.StructType, prefix: str = "") -> list[tuple[str, str, str]]:
    """(column, field path, type) of a schema, nested fields and fields of arrays of structures included."""
    out = []
    for f in schema.fields:
        path = f"{prefix}{f.name}"
        out.append((path.split(".")[0], path, f.dataType.simpleString()))
        inner = f.dataType.elementType if isinstance(f.dataType, T.ArrayType) else f.dataType
        if isinstance(inner, T.StructType):
            out += columns_of(inner, f"{path}.")
    return out


def metadata(spark: SparkSession, tables: dict[str, DataFrame], project: str = "local", dataset: str = "tpch") -> DataFrame:
    """One row per column and nested field of each table, as the analyzer takes them."""
    rows = [(project, dataset, name, c, path, k + 1, kind) for name, df in tables.items() for k, (c, path, kind) in enumerate(columns_of(df.schema))]
    return spark.createDataFrame(rows, "project_id string, dataset_id string, table_name string, column_name string, field_path string, ordinal_position int, data_type string")
