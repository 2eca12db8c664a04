"""Collections of the proposal sample: lookups, versions, the rule gate and judge scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

MIN_BODY, PASS_SCORE = 40, 3.5


def next_id(rows: DataFrame, key: str = "id") -> DataFrame:
    return rows.agg((F.coalesce(F.max(F.col(key).cast("int")), F.lit(0)) + 1).alias("next_id"))


def answers(ids: DataFrame, rows: DataFrame, key: str = "id") -> DataFrame:
    """A tool's answer for each asked id: the row as JSON, or an error that names the id; of repeated ids of the collection any one."""
    own = rows.dropDuplicates([key]).select(F.col(key).alias("_k"), F.to_json(F.struct(*rows.columns)).alias("_json"))
    missing = F.to_json(F.struct(F.format_string(f"{key}=%s is not known", F.col("asked").cast("string")).alias("error")))
    return ids.select(F.col(key).alias("asked")).join(own, F.col("asked") == F.col("_k"), "left").select(F.col("asked").alias(key), F.coalesce("_json", missing).alias("answer"))


def listing(rows: DataFrame, **wanted) -> DataFrame:
    """A collection's rows; arguments that are not None must match (the filters of a tool's call)."""
    for column, value in wanted.items():
        if value is not None:
            rows = rows.filter(F.col(column) == value)
    return rows


def put(rows: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """Rows with those of ``new`` added, or in place of the ones with their ids."""
    return rows.join(new.select(key), key, "left_anti").unionByName(new)


def gate(title: Column, body: Column, ids: Column, catalog: Column, expected: Column) -> Column:
    """Whether a proposal passes: title, body of some length, known products, one of the expected among them."""
    return (F.length(F.trim(title)) > 0) & (F.length(body) >= MIN_BODY) & (F.size(ids) > 0) & (F.size(F.array_except(ids, catalog)) == 0) & F.arrays_overlap(ids, expected)


def judge(*scores: Column) -> Column:
    """Average of the scores, missing ones 0, to one decimal."""
    total = F.lit(0.0)
    for s in scores:
        total = total + F.coalesce(s.cast("double"), F.lit(0.0))
    return F.round(total / len(scores), 1)


def compare(old: Column, new: Column) -> tuple[Column, Column, Column]:
    """Added, removed and common ids of two versions, in their order and as often as they are listed."""
    without = lambda a, b: F.filter(a, lambda x: ~F.array_contains(b, x))
    return without(new, old), without(old, new), F.filter(old, lambda x: F.array_contains(new, x))


def parse_proposal(text: Column) -> Column:
    """Title, body and product ids of a JSON text; text that is no JSON becomes the body."""
    got = F.from_json(text, "title string, body string, product_ids array<int>")
    return F.struct(F.coalesce(got["title"], F.lit("")).alias("title"), F.coalesce(got["body"], text).alias("body"), F.coalesce(got["product_ids"], F.array().cast("array<int>")).alias("product_ids"))
