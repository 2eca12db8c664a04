"""Registered queries of the engine, with the SQL that checks them."""

from __future__ import annotations

from weftline.plans import lineage, relational

FLAGSHIP = "lineage_edges"


def queries() -> dict:
    return {**lineage.QUERIES, **relational.QUERIES}


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in {**lineage.SQL, **relational.SQL}.items() if v}
