"""Intermediate tables in the folder that the driver and all executors reach.

What is written there is read again by whoever needs it, so a lost executor costs a read and no
lineage.  Tables go with the process, or earlier by ``forget``.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_made: list[tuple[SparkSession, str]] = []


def root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a fresh temporary folder only where none is set and the master is local (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not named:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors reach")
        named = f"file://{tempfile.mkdtemp(prefix='weftline-')}"
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it takes it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def folder(spark: SparkSession, name: str) -> str:
    """A path of its own below the shared folder, deleted when the process ends."""
    path = f"{root(spark)}/weftline-{uuid.uuid4().hex[:12]}-{name}"
    _made.append((spark, path))
    return path


def size_of(spark: SparkSession, path: str) -> int:
    fs, p = file_system(spark, path)
    return fs.getContentSummary(p).getLength()


def written(df: DataFrame, name: str = "t") -> tuple[DataFrame, str]:
    """``df`` written once and read back, and where it lies."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out, path


def forget(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        fs, p = file_system(spark, path)
        fs.delete(p, True)
        _made[:] = [x for x in _made if x[1] != path]


@contextmanager
def passing(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables written inside go at the end, but for those (``written``) that are handed to what this gives."""
    before, kept = {path for _, path in _made}, set()

    def keep(df: DataFrame) -> DataFrame:
        kept.add(df._stored_at)
        return df

    yield keep
    forget(spark, *[path for _, path in _made if path not in before and path not in kept])


def _release() -> None:
    for spark, path in list(_made):
        try:
            forget(spark, path)
        except Exception:  # noqa: BLE001  the session may be gone
            pass


atexit.register(_release)
