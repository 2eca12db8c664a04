"""Vector code compression: product codes found by partial-distance search.

A vector is cut into parts, and each part becomes the number of its nearest codebook entry.  Entries are
compared dimension by dimension, the one in which the codebook varies most first.  After each dimension the
entry with the least distance so far is completed, which gives each vector a best complete distance,
and masks drop every entry whose accumulated distance strictly exceeds it.  Distances are whole numbers,
so what is left at the end holds the nearest entry and all that tie with it; the lowest number wins.

The table is read once a round and nothing of it is written: tasks add up the parts of each
entry, and the codebooks (parts x entries x components) are all that comes to the driver.

Defined results: a vector that is null or has a null, NaN or infinite component is left out; one of
another length than ``dim`` stays with a null code and error and adds nothing to its label;
components beyond ``vectors.LIMIT`` are held there; with fewer vectors than ``entries`` the codebooks have
as many entries; vectors without id start an entry only after all others, equal ids in the order
of their components; null labels are one label; repeated rows are coded each; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, functions as F

from weftline.llm.shared import BROADCAST_BYTES, stored
from weftline.llm.vectors import embeddings, finite, matrix, sums, whole

#: Ways that a label's sum is dealt to the rows of its label when labels are too many to broadcast.
SALTS = 32
#: Vectors compared at once.
BLOCK = 2048


def nearest(q: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest of ``entries`` to each row of ``q`` (ties: the lowest), and its squared distance."""
    n, e = len(q), len(entries)
    dims = np.argsort(-entries.astype(np.float64).var(0), kind="stable")
    rows, at = np.repeat(np.arange(n), e), np.tile(np.arange(e), n)
    so_far, best = np.zeros(n * e, np.int64), np.full(n, np.iinfo(np.int64).max)
    every = np.arange(n)
    for d in dims:
        so_far += (q[rows, d] - entries[at, d]) ** 2
        starts = np.searchsorted(rows, every)
        least = np.minimum.reduceat(so_far, starts)
        leads = np.flatnonzero(so_far == least[rows])
        lead = at[leads[np.searchsorted(rows[leads], every)]]
        best = np.minimum(best, ((q - entries[lead]) ** 2).sum(1))
        alive = so_far <= best[rows]
        rows, at, so_far = rows[alive], at[alive], so_far[alive]
    # The nearest entry is never dropped: its distance so far is at most its own, which is at most any complete one.
    first = np.searchsorted(rows, every)
    return at[first], best


def _codes(v: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry numbers of all parts of all rows, and the sum of their squared distances."""
    parts, width = books.shape[0], books.shape[2]
    out, error = np.zeros((len(v), parts), np.int64), np.zeros(len(v), np.int64)
    for a in range(0, len(v), BLOCK):
        for m in range(parts):
            got, d2 = nearest(v[a : a + BLOCK, m * width : (m + 1) * width], books[m])
            out[a : a + BLOCK, m] = got
            error[a : a + BLOCK] += d2
    return out, error


def compress(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 16, entries: int = 64, rounds: int = 2, dim: int = 64) -> tuple[DataFrame, np.ndarray]:
    """key, label, codes (entry numbers), error, label_error; and the codebooks (part, entry, component)."""
    if dim % parts:
        raise ValueError("a vector's length must be a multiple of its parts")
    width, kinds = dim // parts, dict(rows.dtypes)
    all_ = rows.filter(finite(F.col(vector))).select(F.col(key).alias("id"), F.col(label).alias("label"), whole(F.col(vector)).alias("v"))
    fit = all_.filter(F.size("v") == dim).select("v")
    first = all_.filter(F.size("v") == dim).orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    books = np.array([r.v for r in first], np.int64).reshape(len(first), parts, width).transpose(1, 0, 2).copy()
    e = len(first)
    for _ in range(rounds if e else 0):
        now = books

        def contributions(batch, now=now):
            """Component ``width`` of an entry counts its parts."""
            v = matrix(batch.column("v")).astype(np.int64)
            at, _ = _codes(v, now)
            base = (np.arange(parts) * e + at) * (width + 1)
            with_count = np.concatenate([v.reshape(len(v), parts, width), np.ones((len(v), parts, 1), np.int64)], 2)
            return (base[:, :, None] + np.arange(width + 1)).reshape(-1), with_count.reshape(-1)

        total = np.zeros((parts, e, width + 1), object)
        for at, x in sums(fit, contributions).items():
            total[np.unravel_index(at, total.shape)] = x
        books = np.array([[[s // own[width] for s in own[:width]] if own[width] else now[m, j].tolist() for j, own in enumerate(part)] for m, part in enumerate(total.tolist())], np.int64).reshape(parts, e, width)
    final = books

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            column = batch.column("v")
            ok = np.flatnonzero(np.diff(column.offsets.to_numpy()) == dim)
            codes, error = [None] * len(batch), [None] * len(batch)
            if len(ok):
                got, d2 = _codes(matrix(column.take(pa.array(ok))).astype(np.int64), final)
                for k, c, x in zip(ok.tolist(), got.tolist(), d2.tolist(), strict=True):
                    codes[k], error[k] = c, x
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(codes, pa.list_(pa.int32())), pa.array(error, pa.int64())], ["id", "label", "codes", "error"])

    coded, _ = stored(all_.mapInArrow(run, f"id {kinds[key]}, label {kinds[label]}, codes array<int>, error long"), "codes")
    limit = F.lit((1 << 63) - 1).cast("decimal(38,0)")
    by_label, size = stored(coded.groupBy("label").agg(F.least(F.coalesce(F.sum(F.col("error").cast("decimal(20,0)")), F.lit(0)), limit).cast("long").alias("label_error")), "labels")
    own = by_label.withColumnRenamed("label", "_l")
    if size * 4 <= BROADCAST_BYTES:
        joined = coded.join(F.broadcast(own), F.col("label").eqNullSafe(F.col("_l")))
    else:  # a label's rows go to several tasks
        dealt = coded.withColumn("_s", F.pmod(F.xxhash64("id", "codes"), F.lit(SALTS)).cast("int"))
        joined = dealt.join(own.withColumn("_t", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), F.col("label").eqNullSafe(F.col("_l")) & (F.col("_s") == F.col("_t")))
    return joined.select(F.col("id").alias(key), F.col("label").alias(label), "codes", "error", "label_error"), books


def op12_partial_distance(spark, sf_dir: str) -> DataFrame:
    out, books = compress(embeddings(spark, sf_dir))
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    code = F.array_join(F.transform("codes", lambda x: F.lower(F.lpad(F.hex(x), 2, "0"))), "")
    return out.select("vec_id", code.alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
