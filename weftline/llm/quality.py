"""Quality rules with host verdicts (native).

Base rules fail single documents.  Host rules then pool them: failures are counted by host
(the ``source`` column), each host's failure rate is shrunk with a beta prior fitted to all
hosts by moments, and a host is rejected only if even the lower bound of its shrunk rate is
above ``reject_rate``.  The verdict joins back to every document of the host; the table of
hosts is salted, so that a host with a third of all rows is spread over ``salts`` tasks.

Defined results: a null or empty text has no words and fails; a null source is a host of its
own; repeated rows count each for itself; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weftline.llm.shared import SPACES, documents, join_small, let, materialize, one_space, passing, stored, text_or_empty

SYMBOLS = "#*$%&|<>"
WINDOW = 8


def _pairs(a: str, by: int) -> Column:
    """Hashes of each item of array column ``a`` with the one ``by`` places on, as far as there is one."""
    size = F.greatest(F.size(a) - by, F.lit(0))
    return F.zip_with(F.slice(a, F.lit(1), size), F.slice(a, F.lit(by + 1), size), lambda x, y: F.xxhash64(x, y))


def with_repeat_words(d: DataFrame) -> DataFrame:
    """Add n_repeat_words, from hashes of words in ``_1``: words covered by 8-word windows that occur twice or more in the text.

    Windows are compared by 64-bit hashes built by doubling: 1, 2, 4, 8 words.  Only a text in
    which a window repeats is sorted; then each repeated window adds the words up to the next one.
    Each step is a column of its own, so that nothing is computed again inside a lambda.
    """
    for have, by in ((1, 1), (2, 2)):
        d = d.withColumn(f"_{2 * have}", _pairs(f"_{have}", by)).drop(f"_{have}")
    # Where no 4-word window repeats, no 8-word window does.
    d = d.withColumn("_8", F.when(F.size(F.array_distinct("_4")) < F.size("_4"), _pairs("_4", 4))).drop("_4")
    tagged = F.sort_array(F.transform("_8", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = d.withColumn("_s", F.when(F.size(F.array_distinct("_8")) < F.size("_8"), tagged)).drop("_8")

    def repeated(x: Column, k: Column) -> Column:
        left, right = (F.coalesce(F.get("_s", k + by)["h"] == x["h"], F.lit(False)) for by in (-1, 1))
        return F.when(left | right, x["i"])

    d = d.withColumn("_p", F.sort_array(F.filter(F.transform("_s", repeated), lambda x: x.isNotNull()))).drop("_s")
    gaps = F.zip_with("_p", F.slice("_p", F.lit(2), F.greatest(F.size("_p"), F.lit(0))), lambda a, b: F.when(a.isNull(), 0).otherwise(F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW))))
    total = F.aggregate(gaps, F.lit(0).cast("long"), lambda s, x: s + x)
    return d.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("long"))).drop("_p")


def features(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """Per document: key, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    d = docs.select(F.col(key), F.col(host).alias("host"), text_or_empty(text).alias("_t"))
    d = d.withColumn("_plain", one_space(F.col("_t")))
    without = F.col("_t")
    for x in SYMBOLS:
        without = F.replace(without, F.lit(x), F.lit(""))
    lines = F.filter(F.split("_t", "\n"), lambda x: (x != "") & (F.btrim(x, F.lit(SPACES)) != ""))
    d = d.select(
        key, "host", F.xxhash64("_t").alias("tag"),
        F.length(F.replace("_plain", F.lit(" "), F.lit(""))).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(without)).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        F.transform(F.filter(F.split("_plain", " "), lambda w: w != ""), lambda w: F.xxhash64(w)).alias("_1"),
    )
    return with_repeat_words(d.withColumn("n_words", F.size("_1").cast("long")))


def host_verdicts(rows: DataFrame, reject_rate: float = 0.5, z: float = 2.0) -> DataFrame:
    """host, n_docs, n_failed, shrunk_rate, host_ok from rows with host and base_failed.

    The prior's mean is the mean failure rate of hosts and its weight a + b comes from the
    variance between hosts beyond binomial noise, within 2 and 1000; one row of three sums
    reaches the driver.
    """
    hosts = materialize(rows.groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed")), "hosts")
    rate = F.col("n_failed") / F.col("n_docs")
    s = hosts.agg(F.count(F.lit(1)).alias("k"), F.avg(rate).alias("m"), F.var_pop(rate).alias("v"), F.avg(1 / F.col("n_docs")).alias("inv")).first()
    mean = min(max(s["m"] or 0.0, 1e-4), 1 - 1e-4)
    between = max((s["v"] or 0.0) - mean * (1 - mean) * (s["inv"] or 0.0), 1e-9)
    weight = min(max(mean * (1 - mean) / between - 1, 2.0), 1000.0)
    a, n = F.col("n_failed") + F.lit(mean * weight), F.col("n_docs") + F.lit(weight)
    shrunk = a / n
    lower = shrunk - z * F.sqrt(shrunk * (1 - shrunk) / (n + 1))
    return hosts.select("host", "n_docs", "n_failed", shrunk.alias("shrunk_rate"), (lower <= reject_rate).alias("host_ok"))


def quality_rules(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", min_words: int = 20, max_repeat_percent: int = 30, reject_rate: float = 0.5, salts: int = 32) -> DataFrame:
    """One row per document: its counts, base_failed, kept, and its host's shrunk failure rate."""
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    rows = materialize(features(docs, key, text, host).withColumn("base_failed", failed), "features")
    verdicts, size = stored(host_verdicts(rows, reject_rate).select("host", "shrunk_rate", "host_ok", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt")), "verdicts")
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64(key, "n_words", "word_chars"), F.lit(salts)).cast("int"))
    null_safe = "_host"
    rows, verdicts = (x.withColumn(null_safe, F.coalesce(F.concat(F.lit("h"), F.col("host")), F.lit("-"))) for x in (rows, verdicts))
    joined = join_small(rows, verdicts.drop("host"), size, [null_safe, "_salt"], "left")
    kept = ~F.col("base_failed") & F.coalesce("host_ok", F.lit(True))
    return joined.select(key, "tag", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "host", "shrunk_rate")


def keep_good(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", **rules) -> DataFrame:
    """The documents that the rules keep, all columns as they are."""
    with passing() as keep:
        bad = quality_rules(docs, key, text, host, **rules).filter(~F.col("kept")).select(F.coalesce(F.col(key).cast("string"), F.lit("-")).alias("_id"), F.col("tag").alias("_tag")).distinct()
        bad, size = stored(bad, "rejected")
        keep(bad)
    d = docs.select(F.struct("*").alias("_row"), F.coalesce(F.col(key).cast("string"), F.lit("-")).alias("_id"), F.xxhash64(text_or_empty(text)).alias("_tag"))
    return join_small(d, bad, size, ["_id", "_tag"], "left_anti").select("_row.*")


def op1_host_rules(spark, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
