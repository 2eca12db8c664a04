"""Table functions over partitioned tables, and functions written in SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf


@udtf(returnType="key string, session int, first_at timestamp, last_at timestamp, n int")
class Sessions:
    """One row for each run of a partition's rows (key, ts), in order, without a gap longer than ``gap`` seconds.

    Called with ``TABLE(t) PARTITION BY (key) ORDER BY (ts)``; holds one run at a time, so a partition may have any size.
    """

    def __init__(self):
        self.run = None
        self.number = 0

    def eval(self, row, gap: int):
        if row["ts"] is None:
            return
        if self.run and (row["ts"] - self.run[2]).total_seconds() <= gap:
            self.run[2] = row["ts"]
            self.run[3] += 1
            return
        if self.run:
            yield (self.run[0], self.number, *self.run[1:])
        self.number += 1
        self.run = [row["key"], row["ts"], row["ts"], 1]

    def terminate(self):
        if self.run:
            yield (self.run[0], self.number, *self.run[1:])


#: Functions in SQL that statements of the dialect may call: a scalar one, one with a default and one that gives a table.
SQL_FUNCTIONS = [
    "CREATE OR REPLACE TEMPORARY FUNCTION safe_ratio(a DOUBLE, b DOUBLE) RETURNS DOUBLE RETURN CASE WHEN b = 0 THEN NULL ELSE a / b END",
    "CREATE OR REPLACE TEMPORARY FUNCTION bucket_of(x DOUBLE, width DOUBLE DEFAULT 1000) RETURNS BIGINT RETURN CAST(floor(x / width) AS BIGINT)",
    "CREATE OR REPLACE TEMPORARY FUNCTION parts_of(name STRING) RETURNS TABLE(place INT, part STRING) RETURN SELECT pos, col FROM posexplode(split(name, '[.]'))",
]


def register(spark: SparkSession) -> None:
    spark.udtf.register("sessions", Sessions)
    for statement in SQL_FUNCTIONS:
        spark.sql(statement)
