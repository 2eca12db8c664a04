"""What the operators have in common: intermediate tables, size-checked joins, bounded reads.

Intermediate tables are Parquet files below ``spark.checkpoint.dir``, the folder that
the driver and all executors reach.  A lost executor therefore loses no lineage: what
it had written is read again from there.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Characters that part words: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A joined side of at most this many bytes (measured, not guessed) is broadcast.
BROADCAST_BYTES = 32 << 20

_made: list[tuple[SparkSession, str]] = []


def checkpoint_dir(spark: SparkSession) -> str:
    """The common folder that the cluster names; a fresh temporary one only where none is set (tests)."""
    set_ = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not set_:
        set_ = spark.sparkContext.getCheckpointDir()
        if not set_:
            if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors reach")
            set_ = f"file://{tempfile.mkdtemp(prefix='weftline-')}"
        spark.conf.set("spark.checkpoint.dir", set_)
    return set_.rstrip("/")


def materialize(df: DataFrame, name: str = "t") -> DataFrame:
    """Write ``df`` once to the common folder and read it back: cuts lineage, runs costly work once."""
    return stored(df, name)[0]


@contextmanager
def _shuffles_go(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files; else they stay until the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def stored(df: DataFrame, name: str = "t") -> tuple[DataFrame, int]:
    """``materialize`` and the bytes that the written files take."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/weftline-{uuid.uuid4().hex[:12]}-{name}"
    with _shuffles_go(spark):
        df.write.parquet(path)
    _made.append((spark, path))
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(hadoop).getLength()
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out, size


def forget(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for df in tables:
        _delete(df.sparkSession, df._stored_at)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    _made[:] = [x for x in _made if x[1] != path]


@contextmanager
def passing() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables stored inside go at the end, but for those that are handed to what this gives."""
    before, kept = {path for _, path in _made}, set()

    def keep(df: DataFrame) -> DataFrame:
        kept.add(df._stored_at)
        return df

    yield keep
    for own, path in list(_made):
        if path not in before and path not in kept:
            _delete(own, path)


def release(spark: SparkSession | None = None) -> None:
    """Delete the intermediate tables of this process (of one session, if given)."""
    for own, path in list(_made):
        if spark is None or own is spark:
            try:
                p = own._jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(own._jsc.hadoopConfiguration()).delete(p, True)
            except Exception:  # noqa: BLE001  the session may be gone
                pass
            _made.remove((own, path))


atexit.register(release)


def join_small(big: DataFrame, small: DataFrame, size: int, on: list[str], how: str = "left", limit: int = BROADCAST_BYTES) -> DataFrame:
    """Join; ``small`` (a stored table of ``size`` bytes) is broadcast up to ``limit`` bytes, else both sides are shuffled.

    Parquet may compress well, so a quarter of the limit is what the files may take.
    """
    return big.join(F.broadcast(small) if size * 4 <= limit else small.hint("merge"), on, how)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(c: str = "text") -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once, however often ``then`` uses it, and never copied to a row."""
    return F.element_at(F.transform(F.array(value), then), 1)


def one_space(c: Column) -> Column:
    """U+0009 to U+000D as spaces, so that a text can be split at a plain space."""
    for x in SPACES[1:]:
        c = F.replace(c, F.lit(x), F.lit(" "))
    return c


def words(c: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; an empty array where there is none."""
    return F.filter(F.split(one_space(c), " "), lambda w: w != "")


def lower_ascii(c: Column) -> Column:
    """A-Z to lower case, all else as it is."""
    return F.translate(c, UPPER, LOWER)


def fold_ascii(c: Column) -> Column:
    """A string that is equal for two texts if and only if they are equal with A-Z lowered; faster than ``lower_ascii``.

    The UTF-8 bytes are read as Latin-1 and lowered: A-Z become a-z, lead bytes C2-DE become
    E2-FE and nothing else changes.  The number of continuation bytes that follow still tells
    which lead byte it was, so no other two texts meet.
    """
    return F.lower(F.decode(c.cast("binary"), "ISO-8859-1"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
