"""All queries of the core with their SQL."""

from __future__ import annotations

from manualmill.plans import corpus_queries, fleet_queries, orphan_queries, retrieval_queries, stage_queries

MODULES = [corpus_queries, retrieval_queries, fleet_queries, stage_queries, orphan_queries]
QUERIES = {k: f for m in MODULES for k, f in m.QUERIES.items()}
SQL = {k: s for m in MODULES for k, s in m.SQL.items()}
FLAGSHIP = QUERIES["hybrid_ranking"]
