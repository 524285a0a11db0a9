"""All queries of this subpackage and their SQL."""

from __future__ import annotations

from stemforge.llm import area_queries, lookalike_queries, neardup_queries, scan_queries, size_queries

_MODULES = [lookalike_queries, scan_queries, neardup_queries, size_queries, area_queries]
QUERIES = {k: f for m in _MODULES for k, f in m.QUERIES.items()}
SQL: dict[str, str] = {k: s for m in _MODULES for k, s in getattr(m, "SQL", {}).items()}
