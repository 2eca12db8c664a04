"""Document fingerprints by SpotSigs (native).

An anchor is a common word, or one of marks alone; its spot signature is the chain of the next ``CHAIN`` content
words, other common words between them skipped.  Only the last of several anchors in a row
begins a chain, and the text's start counts as an anchor.  A text's fingerprint is its set of
signatures, sorted; a text with few chains has those of all its content words too, one without any
the hashes of its words instead.  Two
fingerprints are compared by Jaccard similarity: if the shorter is empty, or the lengths alone
rule out ``min_likeness`` (0 in the query, which rules out nothing), nothing is intersected.

The next document is found without a sort of everything in one task: ids are cut into cells of
about as many rows (at most ``MAX_CELLS``), a cell is one window, and the first document of a cell is
handed to the cell before it as well.

Defined results: a null or empty text has an empty fingerprint, like only another such one;
rows with one id are ordered by their texts; null ids come first; one document alone is
its own next; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from weftline.llm.shared import documents, let, lower_ascii, one_space, stored, text_or_empty

#: Common words of English, French, German and Spanish.  Fixed values.
ANCHORS = (
    "a an and are as at be by for from had has have he her his in is it its not of on or she that the their they this to was were which will with you "
    "au aux avec ce ces dans de des du elle en est et il je la le les leur mais ne nous on ou par pas pour que qui sa se ses son sont sur un une vous "
    "aber als am auch auf aus bei das dem den der die ein eine einem einen einer es für hat ich im ist mit nach nicht noch oder sich sie sind so und von war wie wir zu zum zur "
    "al como con cuando del desde donde el ella entre era esta este ha hay las lo los más me mi muy no nos o para pero por se si sin sobre son su sus también una uno y ya"
).split()
MARKS = ".,;:!?\"'()|*#%$&<>-_=+/"
CHAIN = 2
#: A text with fewer chains has those of all its content words besides.
FEW = 2
#: Documents meant for a cell, and the most cells (bounds the table of first ids: 65536 rows).
CELL_ROWS, MAX_CELLS = 2_000, 65_536


def signatures(text: Column) -> Column:
    """Sorted array of the distinct signature hashes of a text."""
    # A word's hash; odd if it is an anchor.
    tagged = F.transform(
        F.filter(F.split(one_space(lower_ascii(text)), " "), lambda w: w != ""),
        lambda w: F.xxhash64(w).bitwiseAND(F.lit(-2)).bitwiseOR(F.when(F.btrim(w, F.lit(MARKS)).isin("", *sorted(set(ANCHORS))), 1).otherwise(0).cast("long")),
    )

    def content(h: Column) -> Column:
        """Of each content word its hash, and the anchor just before it (0: none)."""
        before = F.concat(F.array(F.lit(1).cast("long")), h)
        both = F.zip_with(h, F.slice(before, F.lit(1), F.size(h)), lambda w, p: F.when(w.bitwiseAND(F.lit(1)) == 0, F.struct(w.alias("w"), F.when(p.bitwiseAND(F.lit(1)) == 1, p).otherwise(F.lit(0).cast("long")).alias("a"))))
        return F.filter(both, lambda x: x.isNotNull())

    def chained(h: Column) -> Column:
        def of(c: Column) -> Column:
            after = F.slice(c, F.lit(2), F.greatest(F.size(c), F.lit(0)))
            spots = F.zip_with(c, after, lambda x, y: F.when((x["a"] != 0) & y.isNotNull(), F.xxhash64(x["a"], x["w"], y["w"])))
            plain = F.zip_with(c, after, lambda x, y: F.when(y.isNotNull(), F.xxhash64(x["w"], y["w"])))
            found = F.array_distinct(F.filter(spots, lambda x: x.isNotNull()))
            return let(found, lambda f: F.when(F.size(f) >= FEW, f).otherwise(F.array_union(f, F.filter(plain, lambda x: x.isNotNull()))))

        return let(let(content(h), of), lambda f: F.sort_array(F.when(F.size(f) > 0, f).otherwise(F.array_distinct(h))))

    return let(tagged, chained)


def likeness(a: str, b: str, min_likeness: float = 0.0) -> Column:
    """Jaccard similarity of two sorted signature sets (columns); 0 where their lengths rule out ``min_likeness``."""
    short, long_ = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    both = F.size(F.array_intersect(a, b))
    ratio = both / (F.size(a) + F.size(b) - both)
    return F.when(long_ == 0, 1.0).when((short == 0) | (short < long_ * min_likeness), 0.0).otherwise(ratio)


def in_cells(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, Window]:
    """key, _t and _end: 1 for the copy of a first row in the cell before; and the window that puts a row before its next."""
    ids = docs.select(F.col(key).cast("long").alias("k")).filter("k IS NOT NULL")
    cells = max(1, min(MAX_CELLS, -(-ids.count() // CELL_ROWS)))
    # Spark's ranges hold about as many rows each, however far apart the ids are.
    ranges = ids.repartitionByRange(cells, "k").groupBy(F.spark_partition_id().alias("p")).agg(F.min("k").alias("k"))
    begin = np.array(sorted(r["k"] for r in ranges.select("k").collect()) or [0], np.int64)  # MAX_CELLS numbers at most
    # The last range that begins at or before an id: first among every 256th, then among the 256 from there on.
    known, every = F.col(key).cast("long"), 256
    block = F.greatest(F.size(F.filter(F.lit(begin[::every]), lambda x: x <= known)), F.lit(1)) - 1
    cell = let(block, lambda i: i * every + F.size(F.filter(F.slice(F.lit(begin), i * every + 1, F.lit(every)), lambda x: x <= known)) - 1)
    cell = F.when(F.col(key).isNull(), 0).otherwise(cell)
    d = docs.select(F.col(key), text_or_empty(text).alias("_t")).withColumn("_cell", cell)
    # First row of each cell, told by id and hash of the text; at most MAX_CELLS rows, so its broadcast is bounded.
    order = F.struct(F.col(key).isNotNull().alias("set"), F.col(key).alias("id"), F.xxhash64("_t").alias("h"))
    firsts = d.groupBy("_cell").agg(F.min(order).alias("o"))
    firsts, _ = stored(firsts, "firsts")
    by_cell = Window.orderBy("_cell")  # a window over MAX_CELLS rows at most
    last = F.last("_cell").over(by_cell.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    firsts = firsts.select("_cell", "o", F.coalesce(F.lag("_cell").over(by_cell), last).alias("_to"), F.lag("_cell").over(by_cell).isNull().alias("_wraps"))
    d = d.withColumn("_o", order).join(F.broadcast(firsts.withColumnRenamed("_cell", "_c")), (F.col("_cell") == F.col("_c")) & (F.col("_o") == F.col("o")), "left")
    own = F.struct(F.col("_cell").alias("cell"), F.lit(0).alias("end"))
    lent = F.struct(F.col("_to").alias("cell"), F.lit(1).alias("end"))
    d = d.withColumn("_at", F.explode(F.when(F.col("_to").isNotNull(), F.array(own, lent)).otherwise(F.array(own))))
    d = d.select(key, "_t", "_o", F.col("_at.cell").alias("_cell"), F.col("_at.end").alias("_end"))
    w = Window.partitionBy("_cell").orderBy("_end", "_o")
    return d, w


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", min_likeness: float = 0.0) -> DataFrame:
    """One row per document: the sets of its text and of its edited text, and how like they are."""
    d, w = in_cells(docs, key, text)
    d = d.withColumn("signatures", signatures(F.col("_t"))).withColumn("_next", F.lead("_t").over(w)).withColumn("_next_signatures", F.lead("signatures").over(w)).filter("_end = 0")
    n = F.length("_t")
    q = F.floor(n / 4).cast("int")
    d = d.withColumn("edited", F.concat(F.substring(F.col("_t"), F.lit(1), n - q), F.substring(F.col("_next"), F.lit(1), q)))
    d = d.withColumn("edited_signatures", signatures(F.col("edited")))
    return d.select(key, n.cast("long").alias("n_chars"), "edited", "signatures", "edited_signatures", likeness("signatures", "edited_signatures", min_likeness).alias("near_edited"), likeness("signatures", "_next_signatures", min_likeness).alias("near_next"))


def as_string(signatures_: str) -> Column:
    """A set as text: 16 hexadecimal digits for each signature."""
    return F.lower(F.array_join(F.transform(signatures_, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def op6_spotsigs(spark, sf_dir: str) -> DataFrame:
    d = fingerprints(documents(spark, sf_dir))
    return d.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_string("signatures").alias("fingerprint"), as_string("edited_signatures").alias("edited_fingerprint"), "near_edited", "near_next")
