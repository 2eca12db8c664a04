"""Dialect constructs as DataFrame operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def qualify(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which a condition over window functions holds (QUALIFY)."""
    return df.withColumn("_q", condition).filter("_q").drop("_q")


def star(df: DataFrame, except_: list[str] | None = None, replace: dict[str, Column] | None = None) -> DataFrame:
    """``* EXCEPT (...) REPLACE (...)``."""
    gone, new = set(except_ or ()), replace or {}
    return df.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns if c not in gone])


def pivot(df: DataFrame, group: list[str], column: str, values: dict, aggregates: dict[str | None, Column]) -> DataFrame:
    """Pivot with the dialect's names: ``alias_value``, or the value's name alone for an aggregate without one.

    ``values`` maps values to names; they are stated, so one aggregation does it and no distinct scan comes first.
    """
    out = df.groupBy(*group).pivot(column, list(values)).agg(*[a.alias(k or "v") for k, a in aggregates.items()])
    names = {}
    for value, name in values.items():
        for alias, _ in aggregates.items():
            names[f"{value}_{alias or 'v'}" if len(aggregates) > 1 else str(value)] = f"{alias}_{name}" if alias else name
    return out.select(*group, *[F.col(f"`{old}`").alias(new) for old, new in names.items()])


def unpivot(df: DataFrame, ids: list[str], groups: dict[str, list[str]], value_names: list[str], name: str, include_nulls: bool = False) -> DataFrame:
    """Columns to rows, one or several value columns at a time; groups of nulls go unless asked for."""
    items = F.array(*[F.struct(F.lit(label).alias(name), *[F.col(c).alias(v) for v, c in zip(value_names, cols, strict=True)]) for label, cols in groups.items()])
    out = df.select(*ids, F.explode(items).alias("_x")).select(*ids, "_x.*")
    return out if include_nulls else out.filter(F.coalesce(*value_names).isNotNull())


def islands(df: DataFrame, partition: list[str], order: Column, step: Column) -> DataFrame:
    """Number the runs in which ``step`` (0 or 1: a new run begins) stays 0; for many small partitions (``windows.islands`` for few large ones)."""
    return df.withColumn("island", F.sum(step).over(Window.partitionBy(*partition).orderBy(order)))


def sample(df: DataFrame, keys: list[str], percent: float, seed: int = 0) -> DataFrame:
    """TABLESAMPLE SYSTEM (percent PERCENT), repeatable: rows whose key's hash lies in the lowest part, whatever partition they are in."""
    digest = F.sha2(F.concat_ws(":", F.lit(seed), *keys), 256)
    return df.filter(F.conv(F.left(digest, F.lit(8)), 16, 10).cast("long") < percent / 100 * (1 << 32))


def ordered_list(value: Column, order: Column) -> Column:
    """ARRAY_AGG(value ORDER BY order): sorted in the aggregate's result, nulls kept out."""
    return F.transform(F.array_sort(F.collect_list(F.when(value.isNotNull(), F.struct(order.alias("o"), value.alias("v"))))), lambda x: x["v"])


def first_of_group(df: DataFrame, keys: list[str], value: Column, order: list[Column], limit: int, name: str) -> DataFrame:
    """ARRAY_AGG(value IGNORE NULLS ORDER BY order LIMIT limit) of each group, bounded before rows are shuffled.

    A rank filter over the group keeps ``limit`` rows of each group in each task (Spark's window group limit) and then ``limit`` in all,
    so a group's size does not matter.  Groups without a value have an empty array.
    """
    # Nulls rank last, so that a group without values keeps a row.
    ranked = df.select(*keys, value.alias("_v"), F.row_number().over(Window.partitionBy(*keys).orderBy(value.isNull(), *order)).alias("_r")).filter(F.col("_r") <= limit)
    items = F.collect_list(F.when(F.col("_v").isNotNull(), F.struct("_r", "_v")))
    return ranked.groupBy(*keys).agg(F.transform(F.array_sort(items), lambda x: x["_v"]).alias(name))
