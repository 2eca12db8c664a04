"""URL filters: block and allow rules, then empirical-Bayes host reputation (native).

Labelled pages (``labels`` by the page's id; good: quality 1 and not toxic) are counted by
host.  The rate of good pages is shrunk from the top down: all labelled pages give the prior
of a public suffix, the suffix that of a registered domain, the domain that of a host, each
as a beta-binomial posterior with ``strength`` pseudo-pages.  A page that no rule decides is
blocked if the upper bound of its host's posterior is below ``min_good``, that is, only where
the labels leave no doubt; hosts without labels take their domain's or suffix's posterior.

Defined results: a url that is null or has no ``://`` has empty host and path; a page's label
is the mean of its labels if repeated; without any labels the prior is one half and all pass;
null ids match no label; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weftline.llm.shared import join_small, lower_ascii, materialize, stored

#: The rules of the query: (verdict, host, path prefix).
RULES = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/")]
#: Suffixes of two labels that are registries, not registered domains.  Fixed values.
TWO_LABEL_SUFFIXES = ["ac.uk", "co.jp", "co.kr", "co.uk", "com.ar", "com.au", "com.br", "com.cn", "com.mx", "com.tr", "gov.uk", "net.au", "org.au", "org.uk"]


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, null if none does.

    Rules are a parameter of the call, not data: their list is bounded by what the caller writes.
    """
    out = None
    for verdict, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        said = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, said) if out is None else out.when(fits, said)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def domain_of(host: Column) -> Column:
    """Registered domain: the suffix and one label more (the host itself if it has no more)."""
    return F.when(F.substring_index(host, ".", -2).isin(TWO_LABEL_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


def suffix_of(host: Column) -> Column:
    return F.when(F.substring_index(host, ".", -2).isin(TWO_LABEL_SUFFIXES), F.substring_index(host, ".", -2)).otherwise(F.substring_index(host, ".", -1))


def reputations(judged: DataFrame, hosts: DataFrame, strength: float = 20.0, z: float = 2.0) -> DataFrame:
    """host, good_rate, good_low, good_high of every host in ``hosts``; ``judged`` has host and good (0 to 1)."""
    by_host = judged.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("k"))
    by_host = materialize(hosts.join(by_host, "host", "left").select("host", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix"), F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("k", F.lit(0.0)).alias("k")), "hosts")
    total = by_host.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    prior = ((total["k"] or 0.0) + 1) / ((total["n"] or 0) + 2)
    up = by_host.groupBy("suffix", "domain").agg(F.sum("n").alias("dn"), F.sum("k").alias("dk"))
    top = up.groupBy("suffix").agg(F.sum("dn").alias("sn"), F.sum("dk").alias("sk"))
    shrink = lambda k, n, p: (F.col(k) + p * strength) / (F.col(n) + strength)
    x = by_host.join(up, ["suffix", "domain"]).join(top, "suffix")
    x = x.withColumn("s", shrink("sk", "sn", F.lit(prior))).withColumn("d", shrink("dk", "dn", F.col("s"))).withColumn("good_rate", shrink("k", "n", F.col("d")))
    spread = z * F.sqrt(F.col("good_rate") * (1 - F.col("good_rate")) / (F.col("n") + strength + 1))
    return x.select("host", "good_rate", F.greatest(F.col("good_rate") - spread, F.lit(0.0)).alias("good_low"), F.least(F.col("good_rate") + spread, F.lit(1.0)).alias("good_high"))


def judge_urls(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]] = RULES, key: str = "page_id", url: str = "url", label_key: str = "doc_id", min_good: float = 0.2, strength: float = 20.0, salts: int = 32) -> DataFrame:
    """One row per page: key, host, path, rule, verdict, good_rate (the host's shrunk rate of good pages)."""
    rows = pages.select(F.col(key), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    rows = materialize(rows.withColumn("_r", rule_of(F.col("host"), F.col("path"), rules)), "urls")
    good = labels.groupBy(F.col(label_key).alias(key)).agg(F.avg(((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).cast("double")).alias("good"))
    judged = rows.select(key, "host").join(good.filter(F.col("good").isNotNull()), key)
    # The table of hosts is salted: the pages of one host spread over `salts` tasks.
    rep = reputations(judged, rows.select("host").distinct(), strength).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rep, size = stored(rep, "reputation")
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64(key, "path"), F.lit(salts)).cast("int"))
    x = join_small(rows, rep, size, ["host", "_salt"], "left")
    own = F.when(F.col("good_high") < min_good, "block").otherwise("allow")
    return x.select(key, "host", "path", F.col("_r.rule").alias("rule"), F.coalesce("_r.verdict", own).alias("verdict"), "good_rate")


def op7_host_reputation(spark, sf_dir: str) -> DataFrame:
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")).select("page_id", "host", "path", "rule", "verdict")
