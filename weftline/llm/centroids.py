"""Centroid clustering with Drake's adaptive bounds.

Each vector keeps its cluster, an upper bound of the distance to it, lower bounds of the distances to
its next ``b`` centroids in order, and one lower bound for all the rest.  When centroids have moved,
bounds move with them.  The first rank whose bound lies above the upper bound parts what has to
be compared from what cannot win: no rank, and the vector stays unseen; some, and those centroids
alone are compared and ordered again; all, and the vector is compared with every centroid.  ``b``
starts at a quarter of the centroids and shrinks to the highest rank that a round needed, an
eighth at least.  A bound must lie strictly above, and bounds are rounded outwards, so ties go to the
smaller number exactly as in a full comparison.

Vectors with their bounds are a table of the shared folder, written once a round; a round adds
up only the vectors that changed their cluster.  What comes to the driver are the centroids' sums.

Defined results: a vector that is null, has another length than ``dim`` or a null, NaN or infinite
component is left out; components beyond ``vectors.LIMIT`` are held there; with fewer vectors than
``k`` there are as many centroids; vectors without id start a centroid only after all others, equal ids in
the order of their components; repeated rows are clustered each; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Observation, functions as F

from weftline.llm.shared import forget, stored
from weftline.llm.vectors import embeddings, finite, lists, matrix, squared, sums, whole

#: Relative room for rounding in bounds.
ROOM = 1e-9
MAX_LONG = (1 << 63) - 1


def _up(d2: np.ndarray) -> np.ndarray:
    return np.sqrt(d2.astype(np.float64)) * (1 + ROOM)


def _down(d2: np.ndarray) -> np.ndarray:
    return np.sqrt(d2.astype(np.float64)) * (1 - ROOM)


def _outwards(x: np.ndarray, to: float) -> np.ndarray:
    """As 32-bit numbers on the safe side."""
    return np.nextafter(x.astype(np.float32), np.float32(to))


def compare_all(v: np.ndarray, c: np.ndarray, b: int):
    """Cluster, upper bound, the next ``b`` centroids, lower bounds of these and of the rest."""
    d2 = squared(v, c)
    order = np.argsort(d2, axis=1, kind="stable")
    near = np.take_along_axis(d2, order[:, : b + 2], 1)
    lower = np.full((len(v), b + 1), np.inf)
    lower[:, : near.shape[1] - 1] = _down(near[:, 1:])
    return order[:, 0], _up(near[:, 0]), order[:, 1 : b + 1], lower


def reassign(v: np.ndarray, c: np.ndarray, moved: np.ndarray, cluster: np.ndarray, upper: np.ndarray, near: np.ndarray, lower: np.ndarray):
    """The state after the centroids moved by ``moved``, and the rank that each vector had to look up to."""
    b = near.shape[1]
    upper = upper + moved[cluster]
    lower = lower - np.concatenate([moved[near], np.full((len(v), 1), moved.max())], 1)
    lower = np.minimum.accumulate(lower[:, ::-1], 1)[:, ::-1]
    rank = (upper[:, None] >= lower).sum(1)
    if (open_ := np.flatnonzero(rank)).size:  # the exact distance may certify what the moved bound did not
        upper[open_] = _up(((v[open_] - c[cluster[open_]]) ** 2).sum(1))
        rank[open_] = (upper[open_, None] >= lower[open_]).sum(1)
    cluster, near = cluster.copy(), near.copy()
    for z in range(1, b + 1):
        if not (rows := np.flatnonzero(rank == z)).size:
            continue
        some = np.sort(np.concatenate([cluster[rows, None], near[rows, :z]], 1), 1)
        d2 = ((v[rows, None, :] - c[some]) ** 2).sum(2)
        order = np.argsort(d2, axis=1, kind="stable")
        some, d2 = np.take_along_axis(some, order, 1), np.take_along_axis(d2, order, 1)
        cluster[rows], upper[rows], near[rows, :z], lower[rows, :z] = some[:, 0], _up(d2[:, 0]), some[:, 1:], _down(d2[:, 1:])
    if (rows := np.flatnonzero(rank == b + 1)).size:
        cluster[rows], upper[rows], near[rows], lower[rows] = compare_all(v[rows], c, b)
    return cluster, upper, near, lower, rank


def _round(state: DataFrame, kind: str, c: np.ndarray, moved: np.ndarray | None, b: int) -> DataFrame:
    """All vectors assigned to the centroids ``c``, with their bounds; without ``moved`` by full comparison."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if not len(batch):
                continue
            v = matrix(batch.column("v")).astype(np.int64)
            if moved is None:
                before, rank = None, np.full(len(v), b + 1)
                cluster, upper, near, lower = compare_all(v, c, b)
            else:
                before = batch.column("cluster").to_numpy(zero_copy_only=False)
                near, lower = matrix(batch.column("near")), matrix(batch.column("lower")).astype(np.float64)
                if near.shape[1] > b:  # fewer bounds from now on: rank b stands for all that follow
                    lower = np.minimum.accumulate(lower[:, ::-1], 1)[:, ::-1]
                    near, lower = near[:, :b], lower[:, : b + 1]
                cluster, upper, near, lower, rank = reassign(v, c, moved, before, batch.column("upper").to_numpy().astype(np.float64), near, lower)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("v"), pa.array(cluster, pa.int32()), pa.nulls(len(v), pa.int32()) if before is None else pa.array(before, pa.int32()),
                 pa.array(_outwards(upper, np.inf), pa.float32()), lists(near, pa.int32()), lists(_outwards(lower, -np.inf), pa.float32()), pa.array(rank, pa.int32())],
                ["id", "v", "cluster", "before", "upper", "near", "lower", "rank"],
            )

    return state.mapInArrow(run, f"id {kind}, v array<int>, cluster int, before int, upper float, near array<int>, lower array<float>, rank int")


def cluster_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 40, rounds: int = 5, dim: int = 64, seed: int = 2) -> DataFrame:
    """key, cluster, distance, cluster_inertia, inertia, centroid (its whole-number components)."""
    spark, kind = rows.sparkSession, dict(rows.dtypes)[key]
    state = rows.filter((F.size(vector) == dim) & finite(F.col(vector))).select(F.col(key).alias("id"), whole(F.col(vector)).alias("v"))
    first = state.withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)).orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()
    k = len(first)
    c = np.array([r.v for r in first], np.int64).reshape(k, dim)
    total, count = [[0] * dim for _ in range(k)], [0] * k
    b, least, moved, last = max(min(k - 1, -(-k // 4)), 0), -(-k // 8), None, None

    def contributions(batch):
        """A moved vector leaves one cluster's sums and joins another's; component ``dim`` counts."""
        v = np.concatenate([matrix(batch.column("v")), np.ones((len(batch), 1), np.int64)], 1).astype(np.int64)
        keys, values = [], []
        for name, sign in (("cluster", 1), ("before", -1)):
            at = batch.column(name).to_numpy(zero_copy_only=False)
            ok = np.flatnonzero(~np.isnan(at.astype(np.float64)))
            keys.append((at[ok].astype(np.int64)[:, None] * (dim + 1) + np.arange(dim + 1)).reshape(-1))
            values.append((sign * v[ok]).reshape(-1))
        return np.concatenate(keys), np.concatenate(values)

    for number in range(rounds if k else 0):
        seen = Observation()
        step = _round(state, kind, c, moved, b).observe(seen, F.max("rank").alias("rank"))
        state, _ = stored(step, "bounds")
        if last is not None:
            forget(last)
        last = state
        change = sums(state.filter("before IS NULL OR before <> cluster").select("v", "cluster", "before"), contributions)
        for at, x in change.items():
            j, i = divmod(at, dim + 1)
            if i < dim:
                total[j][i] += x
            else:
                count[j] += x
        new = np.array([[s // count[j] for s in total[j]] if count[j] else c[j].tolist() for j in range(k)], np.int64)
        moved = _up(((new - c) ** 2).sum(1))
        if not change or (new == c).all():  # nothing moves any more
            c = new
            break
        if number:  # the first round compares everything
            b = min(b, max(seen.get["rank"], least))
        c = new

    final = state if not k else _round(state, kind, c, moved, b)
    fixed = c

    def distances(batches):
        import pyarrow as pa

        for batch in batches:
            if not len(batch):
                continue
            at = batch.column("cluster").to_numpy(zero_copy_only=False)
            d2 = ((matrix(batch.column("v")).astype(np.int64) - fixed[at]) ** 2).sum(1)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("cluster"), pa.array(d2, pa.int64())], ["id", "cluster", "distance"])

    schema = f"id {kind}, cluster int, distance long"
    if not k:
        out, own = spark.createDataFrame([], schema), []
    else:
        out = stored(final.select("id", "v", "cluster").mapInArrow(distances, schema), "clusters")[0]
        forget(last)
        own = out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()  # at most k rows
    held = lambda x: min(int(x), MAX_LONG)
    inertia = held(sum(r.s for r in own))
    small = spark.createDataFrame([(r.cluster, held(r.s), c[r.cluster].tolist()) for r in own], "cluster int, cluster_inertia long, centroid array<long>")
    return out.join(F.broadcast(small), "cluster").select(F.col("id").alias(key), "cluster", "distance", "cluster_inertia", F.lit(inertia).cast("long").alias("inertia"), "centroid")


def op11_drake_bounds(spark, sf_dir: str) -> DataFrame:
    out = cluster_vectors(embeddings(spark, sf_dir))
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256).alias("centroid_sha256"))
