"""Tables of the repository in versions: published together or not at all.

A table is a set of buckets by the hash of its objects' keys, each bucket a folder of Parquet files
that never change.  A version is a manifest that names the folder of each bucket of each table.  A
publish reads and writes only the buckets of the objects that it replaces, for all tables first;
then one rename, which fails if the version exists, makes the new manifest current.  Until
then readers see the old version, and after it the new one.  A failure takes what was staged away
and is raised again; a run that is killed leaves folders that no manifest names, which ``vacuum``
finds.  Two runs that publish at once cannot both win: the second's rename fails.

The file system must refuse a rename onto a file that exists, as HDFS and local disks do.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from weftline.sources.scratch import file_system

BUCKETS = 64


class PublishFailed(RuntimeError):
    """A publish that was rolled back; the tables are as they were."""


class Conflict(PublishFailed):
    """Another run has published in the meantime."""


@dataclass
class Table:
    schema: str
    #: Columns that name the object which a row belongs to.
    keys: list[str]


@dataclass
class Replace:
    """Rows that take the place of all rows of ``objects`` (all rows of the table, if None)."""

    rows: DataFrame
    objects: DataFrame | None = None


class Store:
    def __init__(self, spark: SparkSession, root: str, tables: dict[str, Table], buckets: int = BUCKETS):
        self.spark, self.root, self.tables, self.buckets = spark, root.rstrip("/"), tables, buckets
        self.versions = f"{self.root}/_versions"
        fs, p = file_system(spark, self.versions)
        fs.mkdirs(p)

    # -- manifests ---------------------------------------------------------------
    def version(self) -> int:
        """The current version; 0 before anything is published."""
        return max(self.history(), default=0)

    def history(self) -> list[int]:
        fs, p = file_system(self.spark, self.versions)
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, version: int | None = None) -> dict:
        version = self.version() if version is None else version
        if not version:
            return {"version": 0, "tables": {}}
        fs, p = file_system(self.spark, self._manifest_path(version))
        stream = fs.open(p)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _manifest_path(self, version: int) -> str:
        return f"{self.versions}/{version:012d}.json"

    def _make_current(self, manifest: dict) -> None:
        """Write the manifest beside its place, then move it there; the move decides."""
        jvm = self.spark._jvm
        temporary = f"{self.versions}/.{uuid.uuid4().hex}"
        fs, p = file_system(self.spark, temporary)
        out = fs.create(p, False)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        target = jvm.org.apache.hadoop.fs.Path(self._manifest_path(manifest["version"]))
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri() if p.toUri().getScheme() else fs.getUri(), self.spark._jsc.hadoopConfiguration())
        rename = self.spark.sparkContext._gateway.new_array(getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
        try:
            context.rename(p, target, rename)
        except Exception as e:
            fs.delete(p, False)
            if "FileAlreadyExists" in str(e):
                raise Conflict(f"version {manifest['version']} was published by another run") from e
            raise

    # -- reading ------------------------------------------------------------------
    def read(self, name: str, version: int | None = None) -> DataFrame:
        """A table as of a version (the current one)."""
        return self._read(name, self.manifest(version)["tables"].get(name, {}).values())

    def _read(self, name: str, folders) -> DataFrame:
        schema, paths = self.tables[name].schema, [f"{self.root}/{f}" for f in folders]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    # -- publishing ---------------------------------------------------------------
    def _bucket(self, name: str):
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.tables[name].keys]), F.lit(self.buckets)).cast("int")

    def _stage(self, name: str, change: Replace, before: dict, folder: str) -> dict:
        """Write the buckets that change to ``folder``; the table's buckets then."""
        table = self.tables[name]
        rows = change.rows.select(*[f.name for f in self.spark.createDataFrame([], table.schema).schema]).withColumn("_bucket", self._bucket(name))
        if change.objects is None:
            touched, kept = set(range(self.buckets)), None
        else:
            objects = change.objects.select(*table.keys).distinct()
            both = objects.select(self._bucket(name).alias("b")).union(rows.select("_bucket")).distinct()
            touched = {r.b for r in both.collect()}  # at most ``buckets`` numbers
            kept = self._read(name, [f for b, f in before.items() if int(b) in touched]).join(objects, table.keys, "left_anti").withColumn("_bucket", self._bucket(name))
        out = rows if kept is None else kept.unionByName(rows)
        # Rebalancing splits a bucket with a very large object over several files.
        out.hint("rebalance", "_bucket").write.partitionBy("_bucket").parquet(f"{self.root}/{folder}")
        fs, p = file_system(self.spark, f"{self.root}/{folder}")
        made = {s.getPath().getName().split("=")[1]: f"{folder}/{s.getPath().getName()}" for s in fs.listStatus(p) if s.isDirectory() and "=" in s.getPath().getName()}
        return {b: f for b, f in before.items() if int(b) not in touched} | made

    def publish(self, changes: dict[str, Replace], step: Callable[[str], None] = lambda what: None) -> int:
        """Replace rows of several tables at once; the new version.  ``step`` is told what comes next."""
        old = self.manifest()
        version, tables, staged = old["version"] + 1, dict(old["tables"]), []
        try:
            for name, change in changes.items():
                step(name)
                staged.append(f"{name}/{uuid.uuid4().hex}")
                tables[name] = self._stage(name, change, old["tables"].get(name, {}), staged[-1])
            step("commit")
            self._make_current({"version": version, "at": time.time(), "from": old["version"], "tables": tables})
        except Exception as e:
            for folder in staged:
                fs, p = file_system(self.spark, f"{self.root}/{folder}")
                fs.delete(p, True)
            if isinstance(e, Conflict):
                raise
            raise PublishFailed(f"publish of version {version} failed and was rolled back: {e}") from e
        step("done")
        return version

    def restore(self, version: int) -> int:
        """Make an earlier version current again, as a new one."""
        was, now = self.manifest(version), self.version()
        self._make_current({"version": now + 1, "at": time.time(), "from": version, "tables": was["tables"]})
        return now + 1

    def vacuum(self, keep: int = 2, older_than_s: float = 86_400) -> list[str]:
        """Forget all but the last ``keep`` versions and delete folders that no version names; young ones may be another run's."""
        for v in self.history()[:-keep]:
            fs, p = file_system(self.spark, self._manifest_path(v))
            fs.delete(p, False)
        used = {f.rsplit("/", 1)[0] for v in self.history() for t in self.manifest(v)["tables"].values() for f in t.values()}
        gone = []
        for name in self.tables:
            fs, p = file_system(self.spark, f"{self.root}/{name}")
            for s in fs.listStatus(p) if fs.exists(p) else []:
                folder = f"{name}/{s.getPath().getName()}"
                if folder not in used and s.getModificationTime() / 1000 <= time.time() - older_than_s:
                    fs.delete(s.getPath(), True)
                    gone.append(folder)
        return gone
