"""All queries of this subpackage with their SQL."""

from __future__ import annotations

from manualmill.llm import leakage_queries, markup_queries, mixing_queries, neardup_queries, neighbour_queries, representative_queries, splitting_queries, toxicity_queries

MODULES = [representative_queries, neighbour_queries, neardup_queries, splitting_queries, markup_queries, leakage_queries, mixing_queries, toxicity_queries]
QUERIES = {k: f for m in MODULES for k, f in m.QUERIES.items()}
SQL = {k: s for m in MODULES for k, s in m.SQL.items()}
