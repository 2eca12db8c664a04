"""Line dedup by sorted line hashes (native).

Each line's key (stripped of white space, A-Z lowered) is hashed.  The hashes are
range-partitioned with a secondary sort by document and position; of equal hashes of a
document the first in the sorted stream counts, and one very common line is dealt over many ranges.  Partial
counts of the ranges give the hashes that enough documents have.  What
comes back to a document is no text but a compressed keep bitmap: 64 lines to a number, and
numbers only where a line goes.

Defined results: null or empty text is one empty line; rows with one doc_id are one
document when documents are counted, and each loses its own lines; a null doc_id is the
smallest; an empty table gives no rows; other columns stay as they are, but for columns that have the names
of the results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from weftline.llm.shared import SPACES, documents, fold_ascii, join_small, materialize, passing, shuffle_parts, stored, text_or_empty


def line_hashes(docs: DataFrame, key: str, text: str, min_chars: int) -> DataFrame:
    """_id, pos, h (64 bits), g (32 more bits) of every line whose key has ``min_chars`` code points."""

    at = docs.select(F.col(key).alias("_id"), F.xxhash64(text_or_empty(text)).alias("_t"), F.posexplode(F.split(text_or_empty(text), "\n")).alias("pos", "_line"))
    at = at.withColumn("_line", F.btrim("_line", F.lit(SPACES))).filter(F.length("_line") >= min_chars).withColumn("_line", fold_ascii(F.col("_line")))
    return at.select("_id", "_t", "pos", F.xxhash64("_line").alias("h"), F.hash("_line").alias("g"))


def first_lines(lines: DataFrame, parts: int) -> DataFrame:
    """Of each document's equal lines the first: ranges on (h, g, _id) hold them together, so it comes by in the sorted stream without another shuffle."""
    first = Window.partitionBy("h", "g", "_id").orderBy("pos")
    return lines.select("h", "g", "_id", "pos").repartitionByRange(parts, "h", "g", "_id").withColumn("_first", F.row_number().over(first)).filter("_first = 1").drop("_first")


def keep_bitmaps(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """_id, _t, drops: array of (word, bits): bit i of word w is set if line 64 * w + i goes.  Documents that keep all have no row.

    ``_t`` tells texts under a repeated id apart.
    """
    lines = materialize(line_hashes(docs, key, text, min_chars), "lines")
    parts = shuffle_parts(docs.sparkSession)
    per_doc = first_lines(lines, parts)
    # max ignores null ids: they count as a document, and lose to any other.
    common = per_doc.groupBy("h", "g").agg(F.count(F.lit(1)).alias("n"), F.max("_id").alias("last")).filter(F.col("n") >= min_docs)
    common, size = stored(common, "common")
    gone = join_small(lines, common.select("h", "g", "last"), size, ["h", "g"], "inner").filter(~F.col("_id").eqNullSafe(F.col("last")))
    bits = gone.distinct().groupBy("_id", "_t", F.shiftright("pos", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, pos & 63)")).alias("bits"))
    return bits.groupBy("_id", "_t").agg(F.sort_array(F.collect_list(F.struct("w", "bits"))).alias("drops"))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``docs`` with ``kept_text`` (null if nothing went), ``n_lines`` and ``n_dropped``."""
    with passing() as keep:
        drops, size = stored(keep_bitmaps(docs, key, text, min_chars, min_docs), "bitmaps")
        keep(drops)
    null = "_none"
    d = docs.select(F.struct("*").alias("_row"), F.col(key).isNull().alias(null), F.coalesce(F.col(key), F.lit(0)).alias("_id"), text_or_empty(text).alias("_text"))
    d = d.withColumn("_t", F.xxhash64("_text"))
    drops = drops.withColumn(null, F.col("_id").isNull()).withColumn("_id", F.coalesce("_id", F.lit(0)))
    d = join_small(d, drops, size, ["_id", null, "_t"], "left").drop("_id", null, "_t").withColumn("_l", F.split("_text", "\n"))

    def stays(_: Column, i: Column) -> Column:
        mine = F.filter("drops", lambda m: m["w"] == F.shiftright(i, 6))
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), i.bitwiseAND(F.lit(63)))
        return F.coalesce(F.get(mine, F.lit(0))["bits"].bitwiseAND(bit) == 0, F.lit(True))

    d = d.withColumn("_k", F.when(F.col("drops").isNotNull(), F.filter("_l", stays)))
    new = {
        "n_lines": F.size("_l").cast("long"),
        "n_dropped": F.when(F.col("_k").isNull(), 0).otherwise(F.size("_l") - F.size("_k")).cast("long"),
        "kept_text": F.when(F.col("_k").isNotNull(), F.array_join("_k", "\n")),
    }
    return d.select(*[F.col("_row")[c].alias(c) for c in docs.columns if c not in new], *[v.alias(k) for k, v in new.items()])


def op10_line_dedup(spark, sf_dir: str) -> DataFrame:
    d = dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return d.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("kept_text", text_or_empty()), 256).alias("kept_sha256"))
