"""Full-width brackets of formulas to half-width ones, whole formulas at a time, with vetoes."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters of formulas, and operators.
OPERATORS = "+-−×÷*/=＝<>≤≥＜＞^"
_SPAN = re.compile(rf"[A-Za-z0-9Ͱ-Ͽ（）²³¹⁰-₉.,√ {re.escape(OPERATORS)}]+")
_PAIR = re.compile("（([^（）]*)）")


def _vetoed(span: str) -> bool:
    """Words, unbalanced brackets, operators only inside brackets, or an option's mark: no formula."""
    depth = 0
    for c in span:
        depth += (c == "（") - (c == "）")
        if depth < 0:
            return True
    bare = span
    while _PAIR.search(bare):
        bare = _PAIR.sub("", bare)
    return depth != 0 or re.search("[A-Za-z]{3}", span) is not None or not any(c in OPERATORS for c in bare) or re.match("（[A-E]）", span.strip()) is not None


def halve_brackets(text: str | None) -> str | None:
    """The text with the brackets of its formulas half-width; unchanged as a whole if one content would then stand in both widths. Idempotent."""
    if not text:
        return text
    half = str.maketrans("（）", "()")
    out = _SPAN.sub(lambda m: m[0] if "（" not in m[0] or _vetoed(m[0]) else m[0].translate(half), text)
    wide = {m[1] for m in _PAIR.finditer(out)}
    narrow = set(re.findall(r"\(([^()]*)\)", out))
    return text if out != text and wide & narrow else out


def halve_brackets_col(c: Column) -> Column:
    return F.pandas_udf(lambda s: s.map(halve_brackets, na_action="ignore"), "string")(c)
