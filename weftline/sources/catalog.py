"""A catalog as a Spark data source: what lies below a folder, project by project and dataset by dataset.

The layout is ``root/project/dataset/<table>.parquet`` (a file or a folder), ``<view>.sql`` and
``<table>.options.json``.  ``spark.read.format("weftline_catalog").option("root", ...).option("part", ...)`` gives

* ``datasets``: project_id, dataset_id
* ``tables``: project_id, dataset_id, table_name, table_type (BASE TABLE or VIEW), expiration_timestamp
* ``columns``: project_id, dataset_id, table_name, column_name, field_path, ordinal_position, data_type
* ``views``: object_project, object_dataset, object_name, object_type, definition_text

Each dataset is a partition of its own, read by one task: listing, footers and texts are no work of the driver.
Equality and IN filters on the project and the dataset are taken over, so that other datasets are not
opened; those on the table's name keep its files closed.  Options ``project`` and ``dataset`` name the folder of one dataset as it is,
and nothing above that folder is listed.  The executors must reach ``root`` as a path of
their file system (a mount); tables in a store that only Spark reads are described by ``readers.metadata``, which
``dataset_columns`` does for such a path.
"""

from __future__ import annotations

import glob
import json
import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition

from weftline.sources.readers import metadata
from weftline.sources.scratch import file_system

PARTS = {
    "datasets": "project_id string, dataset_id string",
    "tables": "project_id string, dataset_id string, table_name string, table_type string, expiration_timestamp timestamp",
    "columns": "project_id string, dataset_id string, table_name string, column_name string, field_path string, ordinal_position int, data_type string",
    "views": "object_project string, object_dataset string, object_name string, object_type string, definition_text string",
}
#: Places of project, dataset and name among a part's columns.
ADDRESS = ["project_id", "dataset_id", "table_name"], ["object_project", "object_dataset", "object_name"]
#: Spark's names of Arrow types.
SIMPLE = {"int8": "tinyint", "int16": "smallint", "int32": "int", "int64": "bigint", "large_string": "string", "date32[day]": "date", "bool": "boolean", "halffloat": "float"}


class Dataset(InputPartition):
    def __init__(self, project: str, dataset: str):
        self.project, self.dataset = project, dataset


def _type(t) -> str:
    """An Arrow type as Spark names it."""
    import pyarrow.types as k

    if k.is_struct(t):
        return f"struct<{','.join(f'{f.name}:{_type(f.type)}' for f in t)}>"
    if k.is_list(t) or k.is_large_list(t):
        return f"array<{_type(t.value_type)}>"
    if k.is_map(t):
        return f"map<{_type(t.key_type)},{_type(t.item_type)}>"
    if k.is_timestamp(t):
        return "timestamp" if t.tz or t.unit == "ns" else "timestamp_ntz"  # Spark's INT96 have no zone either
    if k.is_decimal(t):
        return f"decimal({t.precision},{t.scale})"
    return SIMPLE.get(str(t), str(t))


def _fields(schema, prefix: str = "") -> Iterator[tuple[str, str, str]]:
    """(column, field path, type) of an Arrow schema, fields of structures and of lists of structures included."""
    import pyarrow.types as t

    for f in schema:
        path = f"{prefix}{f.name}"
        yield path.split(".")[0], path, _type(f.type)
        inner = f.type.value_type if t.is_list(f.type) or t.is_large_list(f.type) else f.type
        if t.is_struct(inner):
            yield from _fields(inner, f"{path}.")


class CatalogReader(DataSourceReader):
    def __init__(self, root: str, part: str, project: str | None = None, dataset: str | None = None):
        self.root, self.part, self.folders = root, part, (project, dataset)
        self.wanted: dict[str, set[str]] = {}

    def pushFilters(self, filters):  # noqa: N802
        for f in filters:
            place = next((names.index(f.attribute[0]) for names in ADDRESS for _ in [0] if isinstance(f, (EqualTo, In)) and f.attribute[0] in names), None)
            if place is None:
                yield f
                continue
            new = {f.value} if isinstance(f, EqualTo) else set(f.value)
            self.wanted[place] = self.wanted[place] & new if place in self.wanted else new

    def _named(self, place: int, names: list[str]) -> list[str]:
        """Entries whose lower-case name the filters let through."""
        return sorted(n for n in names if place not in self.wanted or n.lower() in self.wanted[place])

    def partitions(self):
        folders = lambda at, own: [own] if own else [e.name for e in os.scandir(at) if e.is_dir() and not e.name.startswith((".", "_"))]
        return [Dataset(p, d) for p in self._named(0, folders(self.root, self.folders[0])) for d in self._named(1, folders(f"{self.root}/{p}", self.folders[1]))]

    def read(self, partition: Dataset):
        at, address = f"{self.root}/{partition.project}/{partition.dataset}", (partition.project.lower(), partition.dataset.lower())
        names = [e.name for e in os.scandir(at)]
        stems = lambda end: self._named(2, [n.removesuffix(end) for n in names if n.endswith(end)])
        if self.part == "datasets":
            yield address
        elif self.part == "views":
            for n in stems(".sql"):
                with open(f"{at}/{n}.sql", encoding="utf-8") as f:
                    text = f.read()
                if text.strip():
                    yield (*address, n.lower(), "VIEW", text)
        elif self.part == "tables":
            for n in stems(".parquet"):
                yield (*address, n.lower(), "BASE TABLE", self._expires(f"{at}/{n}.options.json"))
            for n in stems(".sql"):
                yield (*address, n.lower(), "VIEW", None)
        else:
            import pyarrow.parquet as pq

            for n in stems(".parquet"):
                path = f"{at}/{n}.parquet"
                one = path if os.path.isfile(path) else min(glob.glob(f"{path}/*.parquet"), default=None)
                for k, (column, field, kind) in enumerate(_fields(pq.read_schema(one)) if one else ()):
                    yield (*address, n.lower(), column, field, k + 1, kind)

    @staticmethod
    def _expires(path: str):
        import datetime as dt

        if not os.path.exists(path):
            return None
        with open(path, encoding="utf-8") as f:
            text = json.load(f).get("expiration_timestamp")
        return dt.datetime.fromisoformat(text) if text else None


class Catalog(DataSource):
    @classmethod
    def name(cls):
        return "weftline_catalog"

    def schema(self):
        return PARTS[self.options["part"]]

    def reader(self, schema):
        return CatalogReader(self.options["root"].removeprefix("file://"), self.options["part"], self.options.get("project"), self.options.get("dataset"))


def read(spark: SparkSession, root: str, part: str, project: str | None = None, dataset: str | None = None) -> DataFrame:
    """One part of a catalog, of one dataset if its folders are named.  Filters are handed to the source."""
    spark.dataSource.register(Catalog)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    named = {k: v for k, v in (("project", project), ("dataset", dataset)) if v}
    return spark.read.format("weftline_catalog").option("root", root).option("part", part).options(**named).load()


def dataset_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Columns of the tables in a dataset's folder: by the source where it is a path of a file system, else as Spark's own reader tells them."""
    root, project, dataset = folder.rstrip("/").rsplit("/", 2)
    if "://" not in folder or folder.startswith("file://"):
        return read(spark, root or "/", "columns", project, dataset)
    fs, p = file_system(spark, f"{folder.rstrip('/')}/*.parquet")
    tables = {str(s.getPath().getName()).removesuffix(".parquet"): str(s.getPath()) for s in fs.globStatus(p) or []}
    return metadata(spark, {n.lower(): spark.read.parquet(at) for n, at in sorted(tables.items())}, project.lower(), dataset.lower())


def referenced_columns(spark: SparkSession, root: str, names: DataFrame) -> DataFrame:
    """Column metadata of the datasets that statements name (``names``: project_id, dataset_id), as many as there are datasets, read by their tasks alone."""
    wanted = [(r.project_id, r.dataset_id) for r in names.select("project_id", "dataset_id").distinct().collect()]  # one row a dataset
    columns = read(spark, root, "columns")
    picked = columns.filter(columns.project_id.isin(sorted({p for p, _ in wanted})) & columns.dataset_id.isin(sorted({d for _, d in wanted})))
    return picked.join(names.select("project_id", "dataset_id").distinct(), ["project_id", "dataset_id"], "left_semi")
