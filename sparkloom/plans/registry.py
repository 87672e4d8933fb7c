"""Registered queries by name, with the SQL that returns the same rows where SQL can."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: The canonical tables of sparkloom.sources.tables in SQL.
TABLES = {
    "cells_e": "SELECT vec_id AS cell_id, 'c' || (label % 3) AS condition, 'b' || label AS category FROM embeddings",
    "signed_e": "SELECT vec_id AS cell_id, CAST(i - 1 AS VARCHAR) AS program, CAST(embedding[i] AS DOUBLE) AS score FROM embeddings, (SELECT unnest(range(1, 65)) AS i)",
    "usage_e": "SELECT cell_id, program, score * score AS score FROM signed_e",
    "guides_e": "SELECT CAST(g AS INTEGER) AS guide_name, CASE WHEN g % 10 = 0 THEN 'non-targeting' ELSE 't' || (g % 10) END AS target FROM (SELECT unnest(range(0, 40)) AS g)",
    "assign_e": "SELECT vec_id AS cell_id, CAST(vec_id % 40 AS INTEGER) AS guide_name, 1 AS n FROM embeddings UNION SELECT vec_id, CAST((vec_id * 7) % 40 AS INTEGER), 1 FROM embeddings WHERE vec_id % 5 = 0",
    "cell_target_e": "SELECT DISTINCT cell_id, target FROM assign_e JOIN guides_e USING (guide_name) WHERE n > 0",
    "expr_l": "SELECT l_orderkey AS cell_id, l_partkey AS gene_id, sum(l_quantity) AS count FROM lineitem GROUP BY ALL",
    "cells_l": "SELECT o_orderkey AS cell_id, o_orderstatus AS condition, o_orderpriority AS category, o_totalprice AS total, c_mktsegment AS segment FROM orders JOIN customer ON o_custkey = c_custkey",
    "usage_l": "SELECT l_orderkey AS cell_id, CAST(s_nationkey AS VARCHAR) AS program, sum(l_extendedprice) AS score FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL",
    "loading_l": "SELECT CAST(s_nationkey AS VARCHAR) AS program, l_partkey AS gene_id, round(sum(l_quantity * (1 - l_discount)), 6) AS score FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL",
    "guides_l": "SELECT s_suppkey AS guide_name, CASE WHEN s_nationkey = 0 THEN 'non-targeting' ELSE 'n' || s_nationkey END AS target FROM supplier",
    "assign_l": "SELECT DISTINCT l_orderkey AS cell_id, l_suppkey AS guide_name, 1 AS n FROM lineitem",
    "geneset": "SELECT p_brand AS term, p_partkey AS gene_id FROM part",
    "typeset": "SELECT p_type AS term, p_partkey AS gene_id FROM part",
    "trait": "SELECT l_suppkey AS study, p_type AS trait, l_partkey AS gene_id, l_discount AS pval, sum(l_quantity) AS n_cases FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey GROUP BY ALL",
    "assoc": "SELECT 'n' || (l_partkey % 50) AS target_name, CAST(s_nationkey AS VARCHAR) AS program_name, 'c' || (l_linenumber % 3) AS sample, round(ln(avg(l_quantity) / 25.5) * 2, 6) AS log2FC, round(abs(avg(l_tax) - 0.04) * 10, 6) AS adj_pval FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL",
    "gene_dict": "SELECT p_partkey AS gene_id, p_name AS symbol FROM part WHERE p_partkey % 4 <> 0",
    "papers": "SELECT doc_id AS pmid, substring(text, 1, 60) AS title, text AS abstract FROM documents",
    "entities": "SELECT DISTINCT entity FROM (SELECT unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS entity FROM benchmark) WHERE length(entity) >= 5",
}


def with_tables(sql: str, extra: dict[str, str] | None = None) -> str:
    """SQL with the canonical (and extra) tables that it names in front."""
    every = TABLES | (extra or {})
    used: list[str] = []

    def use(text: str) -> None:
        for name, body in every.items():
            if name not in used and _names(text, name):
                use(body)
                used.append(name)

    use(sql)
    head = ",\n".join(f"{n} AS ({every[n]})" for n in used)
    return f"WITH {head}\n{sql}" if head else sql


def _names(text: str, name: str) -> bool:
    return re.search(rf"\b(FROM|JOIN)\s+{name}\b", text) is not None


def register(name: str, sql: str | None = None, extra: dict[str, str] | None = None) -> Callable:
    def keep(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = f
        if sql:
            ORACLES[name] = with_tables(sql, extra)
        return f

    return keep


def load() -> None:
    """Imports all modules that register queries."""
    from importlib import import_module

    for name in ("association", "recode", "tables", "enrichment", "similarity", "calibration", "text", "sources", "factor"):
        import_module(f"sparkloom.plans.{name}")
