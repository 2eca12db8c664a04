"""What operators on vectors have in common: whole-number components, exact sums, batches as matrices."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Whole-number components are held within +-LIMIT, where squared distances of 64 of them fit a long.
LIMIT = 1 << 26


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def finite(c: Column) -> Column:
    """A vector that is not null and has no null, NaN or infinite component."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return c.isNotNull() & ~F.exists(c, bad)


def whole(c: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component."""
    held = lambda x: F.greatest(F.least(x.cast("double") * scale, F.lit(float(LIMIT))), F.lit(float(-LIMIT)))
    return F.transform(c, lambda x: F.floor(held(x)).cast("int"))


def matrix(column) -> np.ndarray:
    """An Arrow list column whose lists have one length as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def lists(m: np.ndarray, kind):
    """A matrix as an Arrow list column."""
    import pyarrow as pa

    return pa.ListArray.from_arrays(pa.array(np.arange(0, m.size + 1, max(m.shape[1], 1)) if m.shape[1] else np.zeros(len(m) + 1), pa.int32()), pa.array(m.reshape(-1), kind))


def squared(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``v`` to all rows of ``c``."""
    if not len(v) or not len(c):
        return np.zeros((len(v), len(c)), np.int64)
    # Whole numbers below 2^22 have products and sums that a double holds exactly, and doubles multiply fast.
    kind = np.float64 if max(np.abs(v).max(), np.abs(c).max()) < 1 << 22 else np.int64
    v, c = v.astype(kind), c.astype(kind)
    return ((v * v).sum(1)[:, None] - 2 * (v @ c.T) + (c * c).sum(1)).astype(np.int64)


def sums(moves: DataFrame, column_groups) -> dict[tuple, int]:
    """Sums of whole numbers by a key from a bounded set: each task adds up its own, Spark adds the tasks.

    ``column_groups(batch)`` gives arrays of keys and values; keys are numbers below the bound that
    the caller knows (clusters times components), so that many rows at most come to the driver.
    """

    def add(batches):
        import pyarrow as pa

        total: dict[int, int] = {}
        for b in batches:
            keys, values = column_groups(b)
            own, at = np.unique(keys, return_inverse=True)
            out = np.zeros(len(own), np.int64)
            np.add.at(out, at, values)
            for k, x in zip(own.tolist(), out.tolist(), strict=True):
                total[k] = total.get(k, 0) + x
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], ["key", "value"])

    return {r.key: r.value for r in moves.mapInArrow(add, "key long, value long").groupBy("key").agg(F.sum("value").alias("value")).collect()}
