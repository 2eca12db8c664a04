"""The closure kept up to date: equal to a closure made anew, on random changes of random graphs."""

import random

import pytest
from weftline.repository import impact

EDGES = "source string, source_column string, target string, target_column string, resolution_status string"


def edges(r, n):
    return [(f"T{r.randrange(6)}", r.choice(["a", "b", None]), f"t{r.randrange(6)}", r.choice(["a", "B", None]), r.choice(["RESOLVED"] * 5 + ["UNRESOLVED"])) for _ in range(n)]


def rows(df):
    return sorted(tuple(map(str, (r.origin, r.origin_column, r.impact_rank, r.impacted, r.impacted_column, r.path, r.is_cycle, r.path_hash))) for r in df.collect())


@pytest.mark.parametrize("seed", range(4))
def test_maintain(spark, seed):
    r = random.Random(seed)
    old = edges(r, 7)
    new = [e for e in old if r.random() < 0.6] + edges(r, r.choice([0, 3]))
    b, a = spark.createDataFrame(old, EDGES), spark.createDataFrame(new, EDGES)
    before, want = impact.closure(b, 5), impact.closure(a, 5)
    got, touched = impact.maintain(before, b, a, 5)
    o, w = rows(before), rows(want)
    assert rows(got) == w and len(set(w)) == len(w)
    assert {(str(x.origin), str(x.origin_column)) for x in touched.collect()} == {x[:2] for x in set(o) ^ set(w)}


def test_a_step_that_another_edge_supports_stays(spark):
    """b.x leads to c.y by its own edge and by that of all of b's columns; one of them goes."""
    all_ = [("a", "k", "b", "x", "RESOLVED"), ("b", "x", "c", "y", "RESOLVED"), ("b", None, "c", "y", "RESOLVED")]
    for gone in (1, 2):
        b, a = spark.createDataFrame(all_, EDGES), spark.createDataFrame([e for k, e in enumerate(all_) if k != gone], EDGES)
        got, touched = impact.maintain(impact.closure(b, 5), b, a, 5)
        assert rows(got) == rows(impact.closure(a, 5))
        assert "a.k" not in {f"{x.origin}.{x.origin_column}" for x in touched.collect()}


def test_no_change_and_no_edges(spark):
    b = spark.createDataFrame(edges(random.Random(9), 5), EDGES)
    old = impact.closure(b, 4)
    got, touched = impact.maintain(old, b, b, 4)
    assert rows(got) == rows(old) and touched.count() == 0
    got, _ = impact.maintain(old, b, b.limit(0), 4)
    assert got.count() == 0
    got, _ = impact.maintain(impact.closure(b.limit(0), 4), b.limit(0), b, 4)
    assert rows(got) == rows(old)
