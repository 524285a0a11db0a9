"""All core queries and their SQL."""

from __future__ import annotations

from stemforge.plans import audit_queries, change_queries, gate_queries, page_queries, parsing_queries, question_queries, statements

QUERIES = {**gate_queries.QUERIES, **question_queries.QUERIES, **change_queries.QUERIES, **parsing_queries.QUERIES, **page_queries.QUERIES, **audit_queries.QUERIES}
SQL: dict[str, str] = {**gate_queries.SQL, **statements.SQL, **change_queries.SQL, **parsing_queries.SQL, **page_queries.SQL, **audit_queries.SQL}
