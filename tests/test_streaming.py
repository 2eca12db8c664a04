"""The job log as a stream with state: repeated, reordered and late jobs, and fingerprints that retire."""

import datetime as dt

import pytest
from weftline.streaming import collector

DAY = dt.datetime(2024, 1, 1)


def job(n, day, k, table="t"):
    return (n, DAY + dt.timedelta(days=day), "u", f"SELECT a FROM {table} WHERE k = {k}")


@pytest.fixture
def run(spark, tmp_path):
    """Feeds batches one by one to the stream and gives its events."""

    def feed(batches):
        out = []
        for n, rows in enumerate(batches):
            spark.createDataFrame(rows, collector.JOB_LOG).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
            stream = spark.readStream.schema(collector.JOB_LOG).parquet(f"{tmp_path}/in")
            events = collector.latest_jobs(stream, dt.timedelta(days=10), "1 day")
            q = events.writeStream.outputMode("update").foreachBatch(lambda b, _, n=n: out.extend((n, r.event, r.job_id) for r in b.collect())).option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
            q.awaitTermination()
        return out

    return feed


def test_latest_and_retired(run):
    got = run([
        [job("a1", 0, 1), job("a2", 2, 2), job("b1", 1, 1, "other")],
        [job("a2", 2, 2), job("a0", 1, 9), job("c1", 5, 1, "third")],  # repeated and reordered: nothing new of a
        [job("a3", 9, 3), job("late", 3, 1, "fourth")],  # late: the watermark is at day 4
        [job("d1", 30, 1, "fifth")],
        [job("d2", 31, 2, "fifth")],
    ])
    assert [e for e in got if e[0] == 0] == [e for e in got if e[0] == 0 and e[1] == "LATEST"] and {e[2] for e in got if e[0] == 0} == {"a2", "b1"}
    assert {e[1:] for e in got if e[0] == 1} == {("LATEST", "c1")}
    assert {e[1:] for e in got if e[0] == 2} == {("LATEST", "a3")}
    assert {e[2] for e in got if e[1] == "RETIRED"} == {"a3", "b1", "c1"}
    assert [e[2] for e in got if e[1] == "LATEST" and e[0] >= 3] == ["d1", "d2"]
    assert all(e[2] != "late" for e in got)
