"""Windows over few large partitions, and bounded ordered aggregates, against Spark's own windows."""

import random

import pytest
from pyspark.sql import Window, functions as F
from weftline.operators import relational, windows


@pytest.fixture(scope="module")
def rows(spark):
    """One key with nearly all rows, a hot order value, null keys, null values and null order."""
    r = random.Random(2)
    data = [(i, r.choice(["hot"] * 12 + ["cold", None]), 50 if r.random() < 0.3 else r.choice([None, *range(-40, 200)]), r.choice([None, 1.5, 2.0, -3.0])) for i in range(1500)]
    return spark.createDataFrame(data, "id int, k string, o int, v double").repartition(3).cache()


def same(got, want):
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(key, got.collect())) == sorted(map(key, want.select(*got.columns).collect()))


@pytest.mark.parametrize("ranges", [1, 7])
@pytest.mark.parametrize("keys", [["k"], []])
def test_running(rows, ranges, keys):
    w = Window.partitionBy(*keys).orderBy("o", "id").rowsBetween(Window.unboundedPreceding, 0)
    got = windows.running(rows, keys, ["o", "id"], {"n": ("count", F.lit(1)), "c": ("count", F.col("v")), "s": ("sum", F.col("v")), "lo": ("min", F.col("v")), "hi": ("max", F.col("v"))}, ranges)
    assert got.columns == [*rows.columns, "n", "c", "s", "lo", "hi"]
    same(got, rows.withColumns({"n": F.count(F.lit(1)).over(w), "c": F.count("v").over(w), "s": F.sum("v").over(w), "lo": F.min("v").over(w), "hi": F.max("v").over(w)}))


def test_running_joins_by_shuffle_beyond_the_broadcast(rows, monkeypatch):
    monkeypatch.setattr(windows, "SMALL", 0)
    w = Window.partitionBy("k").orderBy("o", "id").rowsBetween(Window.unboundedPreceding, 0)
    same(windows.running(rows, ["k"], ["o", "id"], {"n": ("count", F.lit(1))}), rows.withColumn("n", F.count(F.lit(1)).over(w)))


def test_one_key_is_spread(rows):
    """A single key's rows are in several tasks of the second pass."""
    one = windows.running(rows.filter("k = 'hot'"), ["k"], ["o", "id"], {"n": ("count", F.lit(1))}, 6)
    assert one.select(F.spark_partition_id().alias("p")).distinct().count() > 1


def test_shifted(rows):
    w = Window.partitionBy("k").orderBy("o", "id")
    got = windows.shifted(rows, ["k"], ["o", "id"], {"before": (F.col("v"), 1), "third": (F.col("id"), -3)}, 5)
    same(got, rows.withColumn("before", F.lag("v").over(w)).withColumn("third", F.lead("id", 3).over(w)))


def test_islands(rows):
    x = rows.filter("o IS NOT NULL")
    w = Window.partitionBy("k").orderBy("o", "id")
    new = F.when(F.col("o") - F.lag("o").over(w) <= 1, 0).otherwise(1)
    got = windows.islands(x, ["k"], ["o", "id"], ~F.coalesce(F.col("o") - F.col("_p") <= 1, F.lit(False)), {"_p": F.col("o")}, 5)
    same(got, x.withColumn("_s", new).withColumn("island", F.sum("_s").over(w)).drop("_s"))


@pytest.mark.parametrize("before,after", [(0, 0), (3, 0), (0, 7), (30, 11), (1000, 1000)])
def test_range_frame(rows, before, after):
    w = Window.partitionBy("k").orderBy("o").rangeBetween(-before, after)
    got = windows.range_frame(rows, ["k"], "o", {"n": ("count", F.lit(1)), "s": ("sum", F.col("v")), "hi": ("max", F.col("v"))}, before, after)
    same(got, rows.withColumns({"n": F.count(F.lit(1)).over(w), "s": F.sum("v").over(w), "hi": F.max("v").over(w)}))


@pytest.mark.parametrize("before,after", [(0, 0), (1, 0), (2, 5), (500, 0)])
def test_groups_frame(rows, before, after):
    ranked = rows.withColumn("_g", F.dense_rank().over(Window.partitionBy("k").orderBy("o")))
    w = Window.partitionBy("k").orderBy("_g").rangeBetween(-before, after)
    got = windows.groups_frame(rows, ["k"], "o", {"n": ("count", F.col("v")), "lo": ("min", F.col("v"))}, before, after, 4)
    same(got, ranked.withColumn("n", F.count("v").over(w)).withColumn("lo", F.min("v").over(w)))


def test_first_of_group_is_bounded_before_the_shuffle(rows):
    got = relational.first_of_group(rows, ["k"], F.col("v"), [F.desc("o"), F.asc("id")], 4, "top")
    everything = rows.groupBy("k").agg(F.transform(F.array_sort(F.collect_list(F.when(F.col("v").isNotNull(), F.struct((-F.coalesce("o", F.lit(-10**6))).alias("a"), "id", "v")))), lambda x: x["v"]).alias("all"))
    same(got, everything.select("k", F.slice("all", 1, 4).alias("top")))
    plan = relational.first_of_group(rows.sparkSession.range(9).withColumn("k", F.col("id") % 2), ["k"], F.col("id"), [F.asc("id")], 4, "top")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.rindex("WindowGroupLimit") > plan.rindex("Exchange hashpartitioning")
    none = relational.first_of_group(rows.withColumn("v", F.lit(None).cast("double")), ["k"], F.col("v"), [F.asc("id")], 2, "top")
    assert sorted((r.k or "", r.top) for r in none.collect()) == [("", []), ("cold", []), ("hot", [])]
