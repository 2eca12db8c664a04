"""Statements that differ in literal numbers only are analysed once, with the results that each has by itself."""

import json

import pytest
from pyspark.sql import functions as F
from weftline.dialect.lineage import Catalog, analyze, discover_sources
from weftline.dialect.tokens import Masked, mask
from weftline.functions.analysis import RESULT, _rows
from weftline.repository import batch
from weftline.sources import scratch

META = [{"project_id": "p", "dataset_id": "d", "table_name": t, "column_name": c, "ordinal_position": k} for t in ("t", "u_2024", "x-12", "9") for k, c in enumerate(("a", "b", "c"))]
STATEMENTS = [
    "SELECT a * 12 AS x, b\n - 345 AS y FROM d.t WHERE a > 7 AND c BETWEEN 10 AND 20 LIMIT 5 OFFSET 6", "SELECT a FROM `d.t` WHERE b = '= 12' AND c = 12 -- AND = 12\n/* = 3 */ # = 4",
    "SELECT 12, 13 + 14 FROM d.u_2024 WHERE u_2024.a = 1.5 AND b > 1e5 AND c < 17", "SELECT x.a FROM p.d.x-12 AS x WHERE x.b = 12", "SELECT a FROM d.9 WHERE a = 9", "SELECT a FROM 9 AS n WHERE 9 = n.a",
    "SELECT * FROM (SELECT a, b FROM d.t) PIVOT (SUM(a) AS s FOR b IN (1, 22)) WHERE s_1 > 3", "SELECT 1 AS n FROM d.t ORDER BY 1", "SELECT 44 FROM (", "SELECT a FROM d.t WHERE > 17 ) 18", "SELECT a FROM d.t WHERE a = 5 5",
    "SELECT CASE WHEN a > 100 THEN 200 ELSE 300 END AS k, nosuch + 4 AS m FROM d.t GROUP BY 1, 2 HAVING SUM(b) > 50", "SELECT a FROM d.t WHERE c = @5 AND b = ? AND a = 33", "SELECT a/5 AS r, b %6 AS s, c-7 AS u, c*8 AS v FROM d.t",
    "SELECT a FROM UNNEST([1, 2]) AS a WHERE a = 3", "SELECT a FROM d.t WHERE a = 1 AND b = 2", "", "SELECT a LIMIT 3abc", "SELECT a FROM d.t WHERE b = r'\\' AND c = 77", "SELECT a FROM /* = */ 9 AS n WHERE a = /* x */ 9", "SELECT a FROM 1e+5 AS n WHERE b = 2e+5 AND c = 2 +5", "SELECT a FROM t AS x, 9 AS y WHERE x.a = 'it''s' AND 9 = 9 -- AND\n 9", "SELECT b AS limit FROM d.t AS t WHERE t.limit 5", "SELECT DATE_ADD(a, INTERVAL 30 DAY) AS e FROM d.t WHERE a = 1 - 2 - 3",
]


def back(value, numbers, marks):
    """A result with numbers for marks, wherever they stand."""
    text = json.dumps(value, ensure_ascii=False)
    for number, mark in zip(numbers, marks, strict=True):
        text = text.replace(mark * len(number), number)
    return json.loads(text)


@pytest.mark.parametrize("sql", STATEMENTS)
def test_a_shape_tells_what_its_statements_tell(sql):
    from weftline.dialect.tokens import MARKS

    shape, numbers = mask(sql)
    assert len(shape) == len(sql)
    text = Masked(shape) if numbers else shape
    assert back(analyze(text, Catalog(META)), numbers, MARKS[: len(numbers)]) == analyze(sql, Catalog(META))
    assert discover_sources(text) == discover_sources(sql)


def test_statements_of_one_shape_are_analysed_once(spark):
    assert mask("SELECT a FROM t WHERE b = 12 AND c > 3")[1] == ["12", "3"] and mask("SELECT a FROM p-12.d.t LIMIT 70")[1] == ["70"]
    texts = [s.replace("12", str(n)) for s in STATEMENTS for n in range(10, 60)] + [None]
    d = spark.createDataFrame([("p", "d", f"v{k}", "VIEW", t) for k, t in enumerate(texts)], "object_project string, object_dataset string, object_name string, object_type string, definition_text string")
    meta = spark.createDataFrame([tuple(r.get(c) for c in batch.FIELDS[:4]) + (r["column_name"], r["ordinal_position"]) for r in META], ", ".join(f"{c} {'int' if c == 'ordinal_position' else 'string'}" for c in batch.FIELDS))
    before = len(scratch._made)
    got = {r.definition_text: r.result.asDict(True) for r in batch.run(d, meta).collect()}
    shapes = next(path for _, path in scratch._made[before:] if path.endswith("-shapes"))
    assert spark.read.parquet(shapes).count() == len({(mask(t)[0], bool(mask(t)[1])) for t in texts}) < 200
    for t in set(texts):
        names = discover_sources(t) or []
        own = [r for r in META if any(n in (r["table_name"], f"d.{r['table_name']}", f"p.d.{r['table_name']}") for n in names)]
        assert got[t] == _rows(analyze(t, Catalog(own)), RESULT), t
    assert batch.run(d, meta).filter(F.col("object_name").isNull()).count() == 0
