"""Spelling of SQL for DuckDB: ``rr(x, p, r)``, ``rc(x, p)`` and ``rl(x, p)`` (replace all, count, match of a regular
expression), ``<q>`` and ``<first>`` (the latest and the first delivery of each question); ``{name}`` is a table.
"""

from __future__ import annotations

import re
from collections.abc import Callable

FIRST = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY loaded_at, row_id) AS rn_ FROM bank) t_ WHERE rn_ = 1)"
LATEST = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY loaded_at DESC, row_id DESC) AS rn_ FROM bank) t_ WHERE rn_ = 1)"


def call(sql: str, name: str, make: Callable[[list[str]], str]) -> str:
    """Replace name(a, b, ...) by make([a, b, ...]), also nested."""
    while m := re.search(rf"(?<![A-Za-z_]){name}\(", sql):
        depth, quoted, args, at = 1, False, [], m.end()
        i = at
        while depth:
            c = sql[i]
            if c == "'":
                quoted = not quoted
            elif not quoted and c in "([":
                depth += 1
            elif not quoted and c in ")]":
                depth -= 1
            if not quoted and (depth == 0 or (depth == 1 and c == ",")):
                args.append(sql[at:i].strip())
                at = i + 1
            i += 1
        sql = sql[: m.start()] + make(args) + sql[i:]
    return sql


def duck_sql(sql: str) -> str:
    sql = sql.replace("<q>", LATEST).replace("<first>", FIRST)
    sql = call(sql, "rr", lambda a: f"regexp_replace({', '.join(a)}, 'g')")
    sql = call(sql, "rc", lambda a: f"CAST(len(regexp_extract_all({a[0]}, {a[1]})) AS BIGINT)")
    sql = call(sql, "rl", lambda a: f"regexp_matches({a[0]}, {a[1]})")
    return re.sub(r"\{(bank|explanations|anchor_packs|figure_files|answer_events|documents|proof_stems|areas|area_labels)\}", r"\1", sql)
