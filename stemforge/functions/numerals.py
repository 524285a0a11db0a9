"""Chinese numerals as higher-order folds over characters: whole-stage Catalyst, no Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Numeral characters.
DIGITS = "零〇一二兩三四五六七八九"
VALUES = "001223456789"
UNITS = {"十": 10, "百": 100, "千": 1000}
SECTIONS = {"萬": 10_000, "億": 100_000_000}
NUMERAL = "[零〇一二兩三四五六七八九十百千萬億]"


def chinese_integer(c: Column) -> Column:
    """Value of a numeral: a run without unit signs is a digit string, else digits times units, sections of 萬 and 億. Anything else is null."""
    weights = {**{d: int(v) for d, v in zip(DIGITS, VALUES, strict=True)}, **UNITS, **SECTIONS}
    known = F.create_map(*[F.lit(x).cast(t) for d, v in weights.items() for x, t in ((d, "string"), (v, "bigint"))])
    zero = F.array(*[F.lit(0).cast("bigint")] * 3)  # finished sections, the open section, the last digit

    def step(acc: Column, ch: Column) -> Column:
        v = F.element_at(known, ch)
        fold = lambda acc, v: F.when(v >= 10_000, F.array(acc[0] + F.greatest(acc[1] + acc[2], F.lit(1)) * v, F.lit(0).cast("bigint"), F.lit(0).cast("bigint"))).when(v >= 10, F.array(acc[0], acc[1] + F.greatest(acc[2], F.lit(1)) * v, F.lit(0).cast("bigint"))).otherwise(F.array(acc[0], acc[1], v))
        return fold(acc, v)

    folded = F.aggregate(F.filter(F.split(c, ""), lambda x: x != ""), zero, step, lambda a: a[0] + a[1] + a[2])
    return F.when(c.rlike(f"^[{DIGITS}]+$"), F.translate(c, DIGITS, VALUES).cast("bigint")).when(c.rlike(f"^{NUMERAL}+$"), folded)


def ascii_width(c: Column) -> Column:
    """Full-width ASCII forms and the ideographic space to their half-width ones."""
    wide = "".join(chr(0xFF01 + i) for i in range(94)) + "　"
    return F.translate(c, wide, "".join(chr(0x21 + i) for i in range(94)) + " ")


def article_number(c: Column) -> Column:
    """``N`` or ``N-M`` in ASCII digits from any spelling of an article number (第44條之3, ４４－３, 四十四之三); the spelling itself where none is recognised."""
    s = F.regexp_replace(ascii_width(c), r"[\s\p{Z}\u200b-\u200f\u2060\ufeff\u00ad\ufe0e]+", "")
    s = F.regexp_replace(s, r"[\u2010-\u2015\u2212]", "-")
    pattern = r"^第?(\d+|" + NUMERAL + r"+)條?(?:[-之](\d+|" + NUMERAL + r"+))?條?$"
    parts = F.filter(F.array(F.regexp_extract(s, pattern, 1), F.regexp_extract(s, pattern, 2)), lambda p: p != "")
    numbers = F.transform(parts, lambda p: F.when(p.rlike(r"^\d+$"), F.regexp_replace(p, r"^0+(?=\d)", "")).otherwise(chinese_integer(p).cast("string")))
    return F.when(F.size(parts) == 0, s).otherwise(F.array_join(numbers, "-"))
