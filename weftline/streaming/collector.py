"""Incremental collection: new files of a job log are folded into the latest definition per fingerprint."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from weftline.functions.analysis import fingerprint_column

JOB_LOG = "job_id string, creation_time timestamp, user_email string, query_text string"


def job_stream(spark: SparkSession, path: str, lateness: str = "3 days", per_batch: int = 100) -> DataFrame:
    """Jobs as they arrive, without repeated deliveries; state older than ``lateness`` is dropped."""
    jobs = spark.readStream.schema(JOB_LOG).option("maxFilesPerTrigger", per_batch).parquet(path)
    return jobs.withWatermark("creation_time", lateness).dropDuplicatesWithinWatermark(["job_id"])


def fold(state: DataFrame | None, batch: DataFrame) -> DataFrame:
    """Latest job of each fingerprint among what is known and what is new."""
    new = batch.withColumn("fingerprint", fingerprint_column("query_text"))
    rows = new if state is None else state.unionByName(new)
    w = Window.partitionBy("fingerprint").orderBy(F.desc("creation_time"), F.desc("job_id"))
    return rows.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def collect(stream: DataFrame, checkpoint: str, apply: Callable[[DataFrame, int], None], mode: str = "append"):
    """Run what has arrived through ``apply`` (batch, its number), which must be idempotent per number, and stop."""
    q = stream.writeStream.outputMode(mode).foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def activity(stream: DataFrame, window: str = "1 hour", lateness: str = "1 hour") -> DataFrame:
    """Jobs per user and window, late ones within the watermark included."""
    return stream.withWatermark("creation_time", lateness).groupBy(F.window("creation_time", window), "user_email").agg(F.count(F.lit(1)).alias("jobs"))


STATE = "creation_time timestamp, job_id string, user_email string, query_text string"
EVENTS = "fingerprint string, event string, creation_time timestamp, job_id string, user_email string, query_text string"


def latest_jobs(jobs: DataFrame, keep: dt.timedelta, lateness: str = "3 days") -> DataFrame:
    """The latest job of each fingerprint as a stream of events: LATEST when one is seen, RETIRED when none came for ``keep``.

    One row of state a fingerprint.  A job that is not newer than the known one changes nothing, so repeated and reordered
    deliveries give the same events at the end; jobs older than the watermark are dropped.  Once the watermark has
    passed a job's time and ``keep``, the fingerprint's state goes, so state follows the fingerprints in use.
    """
    known = jobs.withColumn("fingerprint", F.sha2(fingerprint_column("query_text"), 256)).withWatermark("creation_time", lateness)
    millis = int(keep.total_seconds() * 1000)

    def run(key, batches, state):
        if state.hasTimedOut:
            at, *rest = state.get
            state.remove()
            yield pd.DataFrame([(key[0], "RETIRED", pd.Timestamp(at), *rest)], columns=EVENT_NAMES)
            return
        old = new = state.get if state.exists else None
        for b in batches:
            for row in b[["creation_time", "job_id", "user_email", "query_text"]].itertuples(index=False, name=None):
                row = (row[0].to_pydatetime(), *row[1:])
                if new is None or row[:2] > (pd.Timestamp(new[0]).to_pydatetime(), new[1]):
                    new = row
        if new is not old:
            state.update(new)
            yield pd.DataFrame([(key[0], "LATEST", pd.Timestamp(new[0]), *new[1:])], columns=EVENT_NAMES)
        # A timeout lies past the watermark; what is older already goes at the next batch.
        due = int(pd.Timestamp(new[0]).tz_localize("UTC").timestamp() * 1000) + millis
        state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs() + 1))

    return known.groupBy("fingerprint").applyInPandasWithState(run, EVENTS, STATE, "update", "EventTimeTimeout")


EVENT_NAMES = [f.split(" ")[0] for f in EVENTS.split(", ")]
