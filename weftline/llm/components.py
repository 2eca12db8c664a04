"""Connected components of an edge table: each task joins its own edges, alternating large and small stars join the tasks'."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from weftline.llm.shared import BROADCAST_BYTES, forget, materialize

#: Edges that one task joins at once.
TASK_EDGES = 1_000_000

#: A node's pairs are dealt to so many tasks.
SALTS = 8
#: At most what a node and its least partner, two whole numbers, take in a broadcast table.
NODE_BYTES = 128


def _nearest(pairs: DataFrame, small: bool) -> DataFrame:
    """(v, u, m): each pair with the least of v and its partners.

    Partial sums first, then a join: of a ``small`` table of least partners by broadcast, else one that
    deals a star's pairs to several tasks.
    """
    least = pairs.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
    if small:
        return pairs.join(F.broadcast(least), "v")
    least = least.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return pairs.withColumn("_s", F.pmod(F.xxhash64("u"), F.lit(SALTS)).cast("int")).join(least.hint("merge"), ["v", "_s"]).drop("_s")


def _large_star(edges: DataFrame, small: bool) -> DataFrame:
    both = edges.select(F.col("a").alias("v"), F.col("b").alias("u")).union(edges.select(F.col("b").alias("v"), F.col("a").alias("u")))
    return _nearest(both, small).filter("u > v AND u <> m").select(F.col("u").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame, small: bool) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
    x = _nearest(down, small)
    return x.filter("u <> m").select(F.col("u").alias("a"), F.col("m").alias("b")).union(x.select(F.col("v").alias("a"), F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple[int, bool]:
    """The number of nodes, and whether one has two edges down, or one down and one up: no stars around their least nodes yet."""
    ends = edges.select(F.col("a").alias("v"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(edges.select(F.col("b").alias("v"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    ends = ends.groupBy("v").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    s = ends.agg(F.count(F.lit(1)).alias("nodes"), F.bool_or(F.expr("down > 1 OR (down > 0 AND up > 0)")).alias("moving")).first()
    return s["nodes"], bool(s["moving"])


def least_reachable(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct nodes of edges, and the least node that each can reach by them."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        x, y = root[i], root[j]
        open_ = x != y
        if not open_.any():
            return nodes, nodes[root]
        i, j, x, y = i[open_], j[open_], x[open_], y[open_]
        # Larger roots hang below smaller ones; then every node is moved to the root of its root.
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (up := root[root]) is not root and (up != root).any():
            root = up


def _joined(edges: DataFrame, tasks: int) -> DataFrame:
    """Edges from each node of a task to the least that it reaches there: the same components, fewer edges."""

    def run(batches):
        import pyarrow as pa

        def star(parts):
            a, b = (np.concatenate([x[k] for x in parts]) for k in (0, 1))
            nodes, least = least_reachable(a, b)
            keep = nodes != least
            return nodes[keep], least[keep]

        held, size = [], 0
        for x in batches:
            held.append((x.column("a").to_numpy(), x.column("b").to_numpy()))
            size += x.num_rows
            if size >= TASK_EDGES:
                held = [star(held)]
                # A forest that is still this large goes on as it is.
                if (size := len(held[0][0])) > TASK_EDGES // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in held[0]], ["a", "b"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in star(held)], ["a", "b"])

    return edges.select("a", "b").coalesce(tasks).mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node reachable, for every node with an edge.  ``edges`` (stored) has a and b.

    Each task first joins the edges that it reads, up to ``TASK_EDGES`` at a time; where there are more tasks, or more edges
    than that, stars follow.  Each round halves the depth at least; the rounds end when every node has one edge, to a node without one of its
    own: its component's least.  Nodes with their least partners are broadcast while their count bounds what they take.
    """
    some = edges.filter("a <> b").select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    tasks = -(-some.count() // TASK_EDGES) or 1
    e = materialize(_joined(some, tasks), "edges")
    while True:
        nodes, moving = _state(e) if tasks > 1 else (0, False)
        if not moving:
            return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        small, last, tasks = nodes * NODE_BYTES <= BROADCAST_BYTES, e, 2
        e = materialize(_small_star(_large_star(e, small), small), "edges")
        forget(last)
