"""The analyzer over DataFrames of definitions, and its results as tables.

``analyze_definitions`` gives one nested row per definition, in Arrow batches of Python workers;
the tables explode from it.  Column metadata arrives with each definition as an array, restricted
to the tables that it reads, so no worker holds a whole catalog.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from weftline.dialect.lineage import Catalog, analyze, discover_sources
from weftline.dialect.tokens import MARKS, LexError, Masked, declared, fingerprint, mask, tokenize

IDENTITY = ["object_project", "object_dataset", "object_name", "object_type"]
COLUMNS_TYPE = "array<struct<project_id:string,dataset_id:string,table_name:string,column_name:string,field_path:string,ordinal_position:int>>"


def _struct(names: str) -> T.StructType:
    """Fields of a structure; a name is a string's, with a colon an int's, with brackets an array of strings'."""
    kinds = {":": T.IntegerType(), "]": T.ArrayType(T.StringType())}
    return T.StructType([T.StructField(n.rstrip(":[]"), kinds.get(n[-1], T.StringType())) for n in names.split()])


# The columns of the result tables.
RESULT = T.StructType([T.StructField("status", T.StringType())] + [
    T.StructField(part, T.ArrayType(_struct(names)))
    for part, names in {
        "sources": "scope_id: kind name alias role join",
        "scopes": "scope_id: kind parent:",
        "outputs": "scope_id: ordinal: name status lineage_status expression dependencies[]",
        "paths": "output ordinal: table column_name field_path lineage_status",
        "references": "scope_id: clause name status line: column:",
        "usages": "scope_id: usage_type reference_name table column_name field_path line: column: line_text",
        "diagnostics": "severity code line: column: message",
    }.items()
] + [T.StructField("impacts", T.ArrayType(T.StringType()))])
TOKENS = T.ArrayType(_struct("seq: line: column: token normalized kind depth:"))


def _rows(value, kind: T.DataType):
    """A result as tuples in the order of its type's fields."""
    if isinstance(kind, T.StructType):
        return None if value is None else {f.name: _rows(value.get(f.name), f.dataType) for f in kind.fields}
    if isinstance(kind, T.ArrayType):
        return [_rows(v, kind.elementType) for v in value or ()]
    return value


def analyze_definitions(definitions: DataFrame, sql: str = "definition_text", columns: str | None = "columns", variables: str | None = None, target: dict | None = None, masked: str | None = None) -> DataFrame:
    """``definitions`` with ``result``: everything the analyzer tells about each statement (null text: PARTIAL_FAILURE).

    ``masked`` is a column that says which texts are shapes (``shape_column``); their results have marks where the numbers stood (``unmasked``).
    """
    @F.pandas_udf(RESULT)
    def run(text: pd.Series, cols: pd.Series, names: pd.Series, shape: pd.Series) -> pd.DataFrame:
        out = []
        for t, c, n, m in zip(text, cols, names, shape, strict=True):
            rows = [dict(r) for r in c] if c is not None else []
            out.append(_rows(analyze(Masked(t) if m and t is not None else t, Catalog(rows), n if n is not None else (), target), RESULT))
        return pd.DataFrame(out, columns=RESULT.names)

    c = F.col(columns) if columns else F.array().cast(COLUMNS_TYPE)
    v = F.col(variables) if variables else F.array().cast("array<string>")
    return definitions.withColumn("result", run(F.col(sql), c, v, F.col(masked) if masked else F.lit(False)))


def fingerprint_column(sql: str):
    """Fingerprint of a text column; null stays null."""
    @F.pandas_udf("string")
    def run(text: pd.Series) -> pd.Series:
        return text.map(lambda t: None if t is None else fingerprint(t))

    return run(F.col(sql))


def tokens_column(sql: str):
    """Tokens of a text column; null where brackets do not match."""
    @F.pandas_udf(TOKENS)
    def run(text: pd.Series) -> pd.Series:
        def one(t):
            try:
                return [{"seq": x.seq, "line": x.line, "column": x.column, "token": x.text, "normalized": x.norm, "kind": x.kind, "depth": x.depth} for x in tokenize(t)]
            except (LexError, TypeError):
                return None

        return text.map(one)

    return run(F.col(sql))


def sources_column(sql: str, masked: str | None = None):
    """Lower-case names of the physical tables that each statement (or shape, where ``masked`` says so) reads; null for a statement that cannot be read."""
    @F.pandas_udf("array<string>")
    def run(text: pd.Series, shape: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else discover_sources(Masked(t) if m else t) for t, m in zip(text, shape, strict=True)], dtype=object)

    return run(F.col(sql), F.col(masked) if masked else F.lit(False))


def shape_column(sql: str):
    """The shape of each statement, and the numbers that stand for its marks with a space between (empty: the shape is the statement)."""
    @F.pandas_udf("shape string, numbers string")
    def run(text: pd.Series) -> pd.DataFrame:
        both = [mask(t) for t in text]
        return pd.DataFrame({"shape": [s for s, _ in both], "numbers": [" ".join(n) for _, n in both]}, dtype=object)

    return run(F.col(sql))


def unmasked(result: Column, numbers: Column) -> Column:
    """The result of a shape as that of the statement with these ``numbers`` (``shape_column``): they stand in the texts cut out of it."""
    pairs = F.transform(F.split(numbers, " "), lambda n, k: F.struct(F.repeat(F.substring(F.lit(MARKS), k + 1, F.lit(1)), F.length(n)).alias("mark"), n.alias("number")))

    def part(name: str, kind: T.DataType) -> Column:
        text = {"outputs": "expression", "usages": "line_text", "diagnostics": "message"}.get(name)
        if text is None:
            return result[name].alias(name)
        whole = lambda x: F.aggregate(pairs, x[text], lambda t, p: F.replace(t, p["mark"], p["number"]))
        filled = F.transform(result[name], lambda x: F.struct(*[(whole(x) if f == text else x[f]).alias(f) for f in kind.elementType.names]))
        return F.when(numbers == "", result[name]).otherwise(filled).alias(name)

    return F.struct(*[part(f.name, f.dataType) for f in RESULT.fields])


def variables_column(sql: str):
    """Lower-case names of the variables that each script declares."""
    @F.pandas_udf("array<string>")
    def run(text: pd.Series) -> pd.Series:
        return text.map(lambda t: declared(t) if t is not None else None)

    return run(F.col(sql))


def analyze_json(sql: str | None, columns: str | None = None, options: str | None = None, metadata: str | None = None) -> str:
    """The analyzer with text in and out: columns as a JSON list, options as a JSON object.

    Options: ``script_variables``, ``impact_target`` (adds ``impact_status`` and, without an
    impact, a diagnostic that says so), ``source_discovery_only``, ``compact_export`` (outputs,
    paths and diagnostics only) and ``strict_mode`` (a statement that fails or has errors raises
    ValueError).  ``metadata`` is a JSON object that the result repeats.
    """
    own = json.loads(options) if options else {}
    if own.get("source_discovery_only"):
        found = discover_sources(sql)
        out = {"status": "PARTIAL_FAILURE" if found is None else "COMPLETED", "source_tables": found or []}
    else:
        target = own.get("impact_target")
        out = analyze(sql, Catalog(json.loads(columns) if columns else ()), own.get("script_variables") or (), target)
        if target:
            out["impact_status"] = "IMPACT_FOUND" if out["impacts"] else "NO_IMPACT"
            if not out["impacts"]:
                out["diagnostics"] = [*out["diagnostics"], {"severity": "INFO", "code": "IMPACT_NOT_FOUND", "line": None, "column": None, "message": "no output depends on the target"}]
        if own.get("compact_export"):
            out = {k: v for k, v in out.items() if k in ("status", "outputs", "paths", "diagnostics", "impacts", "impact_status")}
    if own.get("strict_mode") and out["status"] in ("PARTIAL_FAILURE", "COMPLETED_WITH_ERRORS"):
        raise ValueError("; ".join(d["message"] for d in out.get("diagnostics", ()) if d["severity"] == "ERROR") or out["status"])
    if metadata:
        out["export_metadata"] = json.loads(metadata)
    return json.dumps(out)


def register(spark: SparkSession) -> None:
    """``fingerprint_sql(text)``, ``analyze_sql(text)`` and ``analyze_sql_with(text, columns, options, metadata)`` (JSON) for SQL, in Arrow batches."""

    def fp(text: pd.Series) -> pd.Series:
        return text.map(lambda t: None if t is None else fingerprint(t))

    def one(text: pd.Series) -> pd.Series:
        return text.map(analyze_json)

    def more(text: pd.Series, columns: pd.Series, options: pd.Series, metadata: pd.Series) -> pd.Series:
        return pd.Series([analyze_json(*x) for x in zip(text, columns, options, metadata, strict=True)])

    for name, f in (("fingerprint_sql", fp), ("analyze_sql", one), ("analyze_sql_with", more)):
        spark.udf.register(name, F.pandas_udf(f, "string"))


def explode_result(analyzed: DataFrame, part: str) -> DataFrame:
    """One row per entry of a part of the results, with the definition's identity."""
    keep = [c for c in analyzed.columns if c not in ("result", "columns", "definition_text")]
    return analyzed.select(*keep, F.col("result.status").alias("analysis_status"), F.explode(f"result.{part}").alias("_x")).select(*keep, "analysis_status", *[F.col(f"_x.{n}").alias("join_type" if n == "join" else f"{part[:-1]}_status" if n == "status" else n) for n in RESULT[part].dataType.elementType.names])
