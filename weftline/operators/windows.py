"""Windows over a few very large partitions.

Spark gives each key of PARTITION BY to one task.  Here a key is spread over ranges of its order.

* Frames that begin with the partition (running sums, row numbers): two passes.  Rows are range-partitioned by
  (key, order) and written once; each range's sums make a small table, in which a range finds what all
  ranges of its key before it add up to; rows then add their own range's prefix to that.
* RANGE and GROUPS frames of bounded width: rows with one order value share their result, so values are
  aggregated first, which the map side does, also for a value that many rows share.  Values are then cut into
  cells at least as wide as the frame, and each goes to its own cell and to the neighbours that may look at it.

Rows whose key is null are one partition, as in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from weftline.sources import scratch

#: How partial results of an aggregate are put together.
MERGE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}
OWN = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
#: A range's sums are broadcast if their files have at most so many bytes, else joined by shuffle.
SMALL = 8 << 20


def _by_key(a: str, b: str, keys: list[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
    return out


def running(df: DataFrame, keys: list[str], order: list[str], aggregates: dict[str, tuple[str, Column]], ranges: int | None = None) -> DataFrame:
    """``df`` with aggregates over ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW.

    ``aggregates`` maps a name to count, sum, min or max and its argument.  ``order`` (ascending columns) must tell all rows
    of a key apart, else their order, as in SQL, is free.  ``count`` of a literal is the row number.
    """
    spark = df.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    args = {name: f"_arg_{name}" for name in aggregates}
    spread = df.withColumns({args[name]: a for name, (_, a) in aggregates.items()}).repartitionByRange(n, *keys, *order).withColumn("_range", F.spark_partition_id())
    spread, _ = scratch.written(spread, "ranges")
    parts = spread.groupBy(*keys, "_range").agg(*[OWN[kind](args[name]).alias(f"_part_{name}") for name, (kind, _) in aggregates.items()])
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carry, at = scratch.written(parts.select(*keys, "_range", *[MERGE[kind](f"_part_{name}").over(before).alias(f"_carry_{name}") for name, (kind, _) in aggregates.items()]), "carry")
    small = F.broadcast(carry) if scratch.size_of(spark, at) <= SMALL else carry
    joined = spread.alias("s").join(small.alias("c"), (F.col("s._range") == F.col("c._range")) & _by_key("s", "c", keys)).select("s.*", *[f"c._carry_{name}" for name in aggregates])
    own = Window.partitionBy(*keys, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def total(name: str, kind: str) -> Column:
        here, past = OWN[kind](args[name]).over(own), F.col(f"_carry_{name}")
        if kind in ("min", "max"):
            return (F.least if kind == "min" else F.greatest)(here, past)
        return F.when(here.isNull() | past.isNull(), F.coalesce(here, past)).otherwise(here + past)

    out = joined.withColumns({name: total(name, kind) for name, (kind, _) in aggregates.items()})
    return out.drop(*args.values(), *[f"_carry_{name}" for name in aggregates], "_range")


def shifted(df: DataFrame, keys: list[str], order: list[str], values: dict[str, tuple[Column, int]], ranges: int | None = None) -> DataFrame:
    """LAG (positive steps) and LEAD (negative): rows meet by their number, whatever range they lie in."""
    with scratch.passing(df.sparkSession) as stays:
        numbered = stays(scratch.written(running(df, keys, order, {"_n": ("count", F.lit(1))}, ranges), "numbered")[0])
    out = numbered
    for name, (value, steps) in values.items():
        other = numbered.select(*keys, (F.col("_n") + steps).alias("_n"), value.alias(name))
        out = out.alias("s").join(other.alias("c"), (F.col("s._n") == F.col("c._n")) & _by_key("s", "c", keys), "left").select("s.*", f"c.{name}")
    return out.drop("_n")


def islands(df: DataFrame, keys: list[str], order: list[str], begins: Column, previous: dict[str, Column], ranges: int | None = None) -> DataFrame:
    """``df`` with the number of its run; ``begins`` says from a row and the ``previous`` values of the row before it that a run begins."""
    x = shifted(df, keys, order, {name: (value, 1) for name, value in previous.items()}, ranges)
    return running(x, keys, order, {"island": ("sum", F.when(begins, 1).otherwise(0))}, ranges).drop(*previous)


def _cells(values: DataFrame, keys: list[str], at: Column, width: int | float, before: int | float, after: int | float, merged: dict[str, Column]) -> DataFrame:
    """Aggregates of values (with a number ``at``) over RANGE BETWEEN before AND after: each value once, in its own cell."""
    cell = lambda x: F.floor(x / F.lit(width)).cast("long")
    placed = values.withColumn("_at", at).withColumn("_home", cell(F.col("_at")))
    # Those that see a value lie from ``after`` below to ``before`` above it; no cell is narrower than either.
    placed = placed.withColumn("_cell", F.explode(F.array_distinct(F.array(cell(F.col("_at") - F.lit(after)), F.col("_home"), cell(F.col("_at") + F.lit(before))))))
    w = Window.partitionBy(*keys, "_cell").orderBy("_at").rangeBetween(-before, after)
    return placed.withColumns({name: m.over(w) for name, m in merged.items()}).filter("_cell <=> _home").drop("_at", "_home", "_cell")


def _framed(df: DataFrame, keys: list[str], order: str, aggregates: dict[str, tuple[str, Column]], framed) -> DataFrame:
    values = df.groupBy(*keys, order).agg(*[OWN[kind](a).alias(f"_part_{name}") for name, (kind, a) in aggregates.items()])
    merged = {name: MERGE[kind](f"_part_{name}") for name, (kind, _) in aggregates.items()}
    results = framed(values, merged).select(*keys, order, *aggregates)
    return df.alias("s").join(results.alias("c"), _by_key("s", "c", [*keys, order])).select("s.*", *[f"c.{name}" for name in aggregates])


def range_frame(df: DataFrame, keys: list[str], order: str, aggregates: dict[str, tuple[str, Column]], before: int | float, after: int | float) -> DataFrame:
    """``df`` with aggregates over RANGE BETWEEN before PRECEDING AND after FOLLOWING of a numeric column; nulls are peers of each other alone."""
    width = max(before, after) or 1
    return _framed(df, keys, order, aggregates, lambda values, merged: _cells(values, keys, F.col(order), width, before, after, merged))


def groups_frame(df: DataFrame, keys: list[str], order: str, aggregates: dict[str, tuple[str, Column]], before: int, after: int = 0, ranges: int | None = None) -> DataFrame:
    """``df`` with aggregates over GROUPS BETWEEN before PRECEDING AND after FOLLOWING: a range over the number of each value."""
    # Cells of a few groups would only be copied to their neighbours.
    width = max(before, after, 1024)

    def framed(values, merged):
        numbered = running(values, keys, [order], {"_g": ("count", F.lit(1))}, ranges)
        return _cells(numbered, keys, F.col("_g"), width, before, after, merged)

    return _framed(df, keys, order, aggregates, framed)
