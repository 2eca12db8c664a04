"""The registered queries of the training-data operators, and SQL for those that it can express."""

from __future__ import annotations

import importlib

#: Query name and the module that has it.
QUERIES = {
    "op1_host_rules": "quality",
    "op2_lattice": "lm",
    "op3_partenum": "ngram_join",
    "op4_pair_index": "encoding",
    "op5_jump_hash": "sharding",
    "op6_spotsigs": "spotsigs",
    "op7_host_reputation": "urls",
    "op8_bucket_pointers": "substrings",
    "op9_dp_packing": "packing",
    "op10_line_dedup": "lines",
    "op11_drake_bounds": "centroids",
    "op12_partial_distance": "codes",
    "op13_certified_repacking": "repacking",
}


def queries() -> dict:
    return {name: getattr(importlib.import_module(f"weftline.llm.{module}"), name) for name, module in QUERIES.items()}


WORD = r"[^\x20\x09-\x0D]+"
ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = rf"""
WITH d AS (SELECT doc_id, source AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, host, t, regexp_extract_all(t, '{WORD}') AS w FROM d),
pos AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM w),
win AS (SELECT doc_id, i, list(word) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS g FROM pos),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win WHERE len(g) = 8) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, range(8) AS r(k) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d),
dup AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM lines WHERE regexp_matches(l, '{WORD}') GROUP BY doc_id),
f AS (SELECT doc_id, host, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words
      FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN cov USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f),
h AS (SELECT host, count(*) AS n, count(*) FILTER (WHERE base_failed) AS k FROM b GROUP BY host),
s AS (SELECT greatest(least(avg(k / n), 0.9999), 0.0001) AS m, var_pop(k / n) AS v, avg(1 / n) AS inv FROM h),
p AS (SELECT m, greatest(least(m * (1 - m) / greatest(v - m * (1 - m) * inv, 1e-9) - 1, 1000), 2) AS wt FROM s),
r AS (SELECT host, (k + m * wt) / (n + wt) AS rate, n + wt + 1 AS z FROM h, p),
ok AS (SELECT host, rate - 2 * sqrt(rate * (1 - rate) / z) <= 0.5 AS host_ok FROM r)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, base_failed, NOT base_failed AND host_ok AS kept
FROM b JOIN ok ON b.host IS NOT DISTINCT FROM ok.host
"""

OP7 = """
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
p AS (SELECT page_id, {lower} AS host, regexp_extract(r, '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM u),
rules(verdict, h, x) AS (VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('allow', 'net', '/de/'), ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')),
hit AS (SELECT page_id, arg_max(h || x, length(h || x)) AS rule, arg_max(verdict, length(h || x)) AS verdict
        FROM p, rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, x) GROUP BY page_id),
good AS (SELECT doc_id AS page_id, avg(CASE WHEN quality = 1 AND coalesce(toxic, 0) = 0 THEN 1.0 ELSE 0.0 END) AS good FROM labels GROUP BY doc_id),
n AS (SELECT host, regexp_extract(host, '([^.]+\\.)?[^.]+$') AS domain, regexp_extract(host, '[^.]*$') AS suffix, count(good) AS n, coalesce(sum(good), 0) AS k
      FROM p LEFT JOIN good USING (page_id) GROUP BY host),
t AS (SELECT (sum(k) + 1) / (sum(n) + 2) AS prior FROM n),
s AS (SELECT suffix, (sum(k) + prior * 20) / (sum(n) + 20) AS s FROM n, t GROUP BY suffix, prior),
d AS (SELECT suffix, domain, (sum(k) + s * 20) / (sum(n) + 20) AS d FROM n JOIN s USING (suffix) GROUP BY suffix, domain, s),
q AS (SELECT host, n, (k + d * 20) / (n + 20) AS g FROM n JOIN d USING (suffix, domain)),
v AS (SELECT host, CASE WHEN g + 2 * sqrt(g * (1 - g) / (n + 21)) < 0.2 THEN 'block' ELSE 'allow' END AS own FROM q)
SELECT p.page_id, p.host, p.path, hit.rule, coalesce(hit.verdict, v.own) AS verdict FROM p LEFT JOIN hit USING (page_id) JOIN v USING (host)
""".replace("{lower}", ASCII_LOWER.format("regexp_extract(r, '^[^/?#]*')"))

OP10 = f"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
k AS (SELECT *, {ASCII_LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM l),
c AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
x AS (SELECT k.*, c.last IS NOT NULL AND doc_id <> c.last AS gone FROM k LEFT JOIN c USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM x GROUP BY doc_id
"""

#: Whole-number vectors without null or non-finite components.
KEPT = "SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
FLOOR = "(({0} - (({0} % {1}) + {1}) % {1}) // {1})::BIGINT"


def op11_sql(k: int = 40, rounds: int = 5, dim: int = 64) -> str:
    """Every round compares all vectors with all centroids: |v|^2 - 2 v c + |c|^2, whole numbers that doubles hold."""
    out = [
        f"WITH kept AS ({KEPT} AND len(embedding) = {dim})",
        "x AS (SELECT vec_id, v, v::DOUBLE[] AS f, list_inner_product(v::DOUBLE[], v::DOUBLE[]) AS q FROM kept)",
        f"c0 AS (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS j, v AS c FROM kept QUALIFY j < {k})",
    ]
    for r in range(rounds + 1):
        out += [f"a{r} AS MATERIALIZED (SELECT vec_id, v, min((q - 2 * list_inner_product(f, c::DOUBLE[]) + list_inner_product(c::DOUBLE[], c::DOUBLE[]))::BIGINT * {k} + j) AS m FROM x, c{r} GROUP BY vec_id, v)"]
        if r < rounds:
            out += [
                f"s{r} AS (SELECT j, i, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT m % {k} AS j, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{r}) GROUP BY j, i)",
                f"n{r} AS (SELECT j, list({FLOOR.format('s', 'n')} ORDER BY i) AS c FROM s{r} GROUP BY j)",
                f"c{r + 1} AS MATERIALIZED (SELECT j, coalesce(n{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN n{r} USING (j))",
            ]
    return (
        ", ".join(out)
        + f" SELECT vec_id, j::INTEGER AS cluster, m // {k} AS distance, sum(m // {k}) OVER (PARTITION BY j)::BIGINT AS cluster_inertia, sum(m // {k}) OVER ()::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256"
        + f" FROM (SELECT *, m % {k} AS j FROM a{rounds}) JOIN c{rounds} USING (j)"
    )


def op12_sql(parts: int = 16, entries: int = 64, rounds: int = 2, dim: int = 64) -> str:
    """Every round compares all parts with all entries of their codebook."""
    w = dim // parts
    d2 = " + ".join(f"(p[{i}] - c[{i}]) * (p[{i}] - c[{i}])" for i in range(1, w + 1))
    out = [
        f"WITH kept AS ({KEPT})",
        f"x AS (SELECT vec_id, m, v[{w} * m + 1 : {w} * m + {w}] AS p FROM kept, range({parts}) AS r(m) WHERE len(v) = {dim})",
        f"c0 AS (SELECT m, row_number() OVER (PARTITION BY m ORDER BY vec_id) - 1 AS e, p AS c FROM x QUALIFY e < {entries})",
    ]
    for r in range(rounds + 1):
        out += [f"a{r} AS MATERIALIZED (SELECT vec_id, m, p, min(({d2}) * {entries} + e) AS b FROM x JOIN c{r} USING (m) GROUP BY vec_id, m, p)"]
        if r < rounds:
            new = ", ".join(FLOOR.format(f"sum(p[{i}])::BIGINT", "count(*)") for i in range(1, w + 1))
            out += [
                f"n{r} AS (SELECT m, b % {entries} AS e, [{new}] AS c FROM a{r} GROUP BY m, b % {entries})",
                f"c{r + 1} AS MATERIALIZED (SELECT m, e, coalesce(n{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN n{r} USING (m, e))",
            ]
    return (
        ", ".join(out)
        + f", g AS (SELECT vec_id, string_agg(printf('%02x', b % {entries}), '' ORDER BY m) AS code, sum(b // {entries})::BIGINT AS error FROM a{rounds} GROUP BY vec_id)"
        + f", h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY m, e)) AS codebooks_sha256 FROM c{rounds})"
        + " SELECT vec_id, code, error, coalesce(sum(error) OVER (PARTITION BY label), 0)::BIGINT AS label_error, codebooks_sha256 FROM kept LEFT JOIN g USING (vec_id), h"
    )


SQL = {"op1_host_rules": OP1, "op7_host_reputation": OP7, "op10_line_dedup": OP10, "op11_drake_bounds": op11_sql(), "op12_partial_distance": op12_sql()}


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in SQL.items() if k in QUERIES}
