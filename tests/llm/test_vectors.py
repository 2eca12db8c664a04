"""Clustering and codes of vectors against full comparison, on odd tables too."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from weftline.llm import centroids, codes, vectors

SCHEMA = "vec_id long, embedding array<float>, label int, id int, v string, h string, key int, cluster string"


def rows(spark, vecs, labels=None):
    """Vectors with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, v, (labels or {}).get(i, i and i % 3), 7, "v", "h", 8, "c") for i, v in vecs], SCHEMA).repartition(4)


def random_vectors(n, dim=64, seed=3, spread=0.05, groups=6):
    r = random.Random(seed)
    middle = [[r.gauss(0, 0.3) for _ in range(dim)] for _ in range(groups)]
    return [(i, [float(np.float32(x + r.gauss(0, spread))) for x in r.choice(middle)]) for i in range(n)]


def odd_vectors(dim=64):
    """Ties, copies, nulls, other lengths, infinite and huge components."""
    r = random.Random(5)
    few = [[r.choice([0.0, 0.01, -0.004]) for _ in range(dim)] for _ in range(8)]
    out = [(i, list(r.choice(few))) for i in range(150)]
    out += [(200, None), (201, []), (202, [0.0] * (dim - 1)), (203, [0.0] * (dim + 1)), (204, [math.nan] + [0.0] * (dim - 1)), (205, [0.0] * (dim - 1) + [math.inf])]
    out += [(206, [None] + [0.0] * (dim - 1)), (207, [3e38] + [0.0] * (dim - 1)), (208, [-3e38] + [0.0] * (dim - 1)), (7, list(few[0])), (7, list(few[1])), (None, list(few[2])), (None, None)]
    return out


def whole(v):
    """Whole-number components of a vector that is kept, else None."""
    if v is None or any(x is None or not math.isfinite(x) for x in v):
        return None
    return [max(min(math.floor(256 * float(np.float32(x))), vectors.LIMIT), -vectors.LIMIT) for x in v]


def lloyd(vecs, k, rounds, dim, seed=2):
    """(id, cluster, distance) of each kept vector and the centroids, by full comparison."""
    own = [(i, w) for i, v in vecs if (w := whole(v)) is not None and len(w) == dim]
    own.sort(key=lambda x: (x[0] is None, hashlib.sha256(f"{seed}:{x[0]}".encode()).hexdigest(), x[1]))
    c = [w for _, w in own[:k]]
    for r in range(rounds + 1):
        at = [min((sum((a - b) ** 2 for a, b in zip(w, o, strict=True)), j) for j, o in enumerate(c)) for _, w in own]
        for j in range(len(c) if r < rounds else 0):
            mine = [w for (_, w), (_, a) in zip(own, at, strict=True) if a == j]
            c[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)] if mine else c[j]
    return [(i, j, d) for (i, _), (d, j) in zip(own, at, strict=True)], c


def product_codes(vecs, labels, parts, entries, rounds, dim):
    own = sorted(((i, w) for i, v in vecs if (w := whole(v)) is not None and len(w) == dim), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    width = dim // parts
    cut = lambda w, m: w[m * width : (m + 1) * width]
    books = [[cut(w, m) for _, w in own[:entries]] for m in range(parts)]
    near = lambda p, b: min((sum((x - y) ** 2 for x, y in zip(p, e, strict=True)), j) for j, e in enumerate(b))
    for _ in range(rounds):
        new = []
        for m in range(parts):
            at = [near(cut(w, m), books[m])[1] for _, w in own]
            mine = [[cut(w, m) for (_, w), a in zip(own, at, strict=True) if a == j] for j in range(len(books[m]))]
            new.append([[sum(x) // len(p) for x in zip(*p, strict=True)] if p else books[m][j] for j, p in enumerate(mine)])
        books = new
    got = [(i, [near(cut(w, m), books[m]) for m in range(parts)]) for i, w in own]
    return [(i, [j for _, j in x], sum(d for d, _ in x)) for i, x in got], books


def same(got, want):
    key = lambda x: (x[0] is None, x[0] or 0, x[1:])
    assert sorted(got, key=key) == sorted(want, key=key)


@pytest.mark.parametrize("vecs,k,rounds,dim", [(random_vectors(300), 40, 5, 64), (random_vectors(200, 8, 9, 0.3), 12, 6, 8), (odd_vectors(), 40, 5, 64), (odd_vectors(4), 5, 3, 4), (random_vectors(3), 40, 2, 64), (random_vectors(9), 1, 2, 64)])
def test_clusters(spark, vecs, k, rounds, dim):
    want, c = lloyd(vecs, k, rounds, dim)
    got = centroids.cluster_vectors(rows(spark, vecs), k=k, rounds=rounds, dim=dim).collect()
    same([(r.vec_id, r.cluster, r.distance) for r in got], want)
    top = (1 << 63) - 1
    for r in got:
        assert r.centroid == c[r.cluster]
        assert r.cluster_inertia == min(sum(d for _, j, d in want if j == r.cluster), top) and r.inertia == min(sum(d for _, _, d in want), top)


def test_no_vectors(spark):
    for df in (rows(spark, [(1, None), (2, [1.0])]), rows(spark, random_vectors(2)).limit(0)):
        out = centroids.cluster_vectors(df)
        assert out.count() == 0 and out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]
    out, books = codes.compress(rows(spark, random_vectors(2)).limit(0))
    assert out.count() == 0 and books.size == 0


def test_bounds_certify():
    """Vectors near their centroid are not compared again, and those that are end as in a full comparison."""
    v = np.array([whole(x) for _, x in random_vectors(800, spread=0.03)])
    c = v[:24].copy()
    cluster, upper, near, lower = centroids.compare_all(v, c, 6)
    ranks = []
    for _ in range(6):
        new = np.array([v[cluster == j].sum(0) // max((cluster == j).sum(), 1) if (cluster == j).any() else c[j] for j in range(24)])
        moved = centroids._up(((new - c) ** 2).sum(1))
        c = new
        cluster, upper, near, lower, rank = centroids.reassign(v, c, moved, cluster, upper, near, lower)
        assert (cluster == vectors.squared(v, c).argmin(1)).all()
        ranks.append((rank == 0).mean())
    assert ranks[-1] > 0.5 and (rank <= 7).all()


def test_nearest_entries():
    r = np.random.default_rng(4)
    for n, e, w, top in ((200, 64, 4, 3), (50, 5, 1, 2), (100, 64, 8, 200), (10, 1, 4, 9), (60, 64, 4, vectors.LIMIT)):
        q, b = r.integers(-top, top + 1, (n, w)), r.integers(-top, top + 1, (e, w))
        at, d2 = codes.nearest(q, b)
        full = ((q[:, None] - b) ** 2).sum(2)
        assert (at == full.argmin(1)).all() and (d2 == full.min(1)).all()


@pytest.mark.parametrize("vecs,parts,entries,dim", [(random_vectors(200), 16, 64, 64), (odd_vectors(), 16, 64, 64), (odd_vectors(8), 2, 3, 8), (random_vectors(5, 6), 3, 64, 6)])
@pytest.mark.parametrize("shuffled", [False, True])
def test_codes(spark, vecs, parts, entries, dim, shuffled, monkeypatch):
    if shuffled:
        monkeypatch.setattr(codes, "BROADCAST_BYTES", 0)
    labels = {i: None for i, _ in vecs if i and i % 5 == 0}
    want, books = product_codes(vecs, labels, parts, entries, 2, dim)
    out, got_books = codes.compress(rows(spark, vecs, labels), parts=parts, entries=entries, dim=dim)
    got = out.collect()
    assert got_books.tolist() == books
    same([(r.vec_id, r.codes, r.error) for r in got if r.codes is not None], want)
    others = [i for i, v in vecs if whole(v) is not None and len(v) != dim]
    assert sorted(r.vec_id for r in got if r.codes is None) == sorted(others)
    for r in got:
        assert r.label_error == min(sum(x.error or 0 for x in got if x.label == r.label), (1 << 63) - 1)


def test_whole_components(spark):
    got = spark.createDataFrame([([0.5, -0.001, 0.0, 1e30],)], "e array<double>").select(vectors.whole(F.col("e")).alias("w"), vectors.finite(F.col("e")).alias("f")).first()
    assert got.w == [128, -1, 0, vectors.LIMIT] and got.f
