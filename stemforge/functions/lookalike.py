"""Visual folding of text: one key for all texts that look the same.

``look_key`` deletes blanks, line ends and invisible characters, resolves width, presentation and ligature
variants, composes accents, and sends look-alike letters of other scripts, and the lengths of a dash or dot, to
one prototype. Superscripts, subscripts, circled numbers and fraction signs stay apart from plain characters, and
so do upper and lower case. Null gives null; an empty or blank text gives ''.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Decompositions that don't look like the plain character.
APART = ("<super>", "<sub>", "<circle>", "<fraction>", "<square>")

# Letters of other scripts that look like a Latin letter.
ALIKE = {
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P",
    "С": "C", "Т": "T", "У": "Y", "Х": "X", "а": "a", "е": "e", "ѕ": "s", "і": "i", "ј": "j", "о": "o", "р": "p",
    "с": "c", "у": "y", "х": "x", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "Ԛ": "Q", "Ԝ": "W",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P",
    "Τ": "T", "Υ": "Y", "Χ": "X", "ο": "o", "ν": "v", "ι": "i",
    "օ": "o", "ո": "n", "ս": "u", "հ": "h",
    "ρ": "p", "υ": "u", "κ": "к", "Ѵ": "V", "ѵ": "v", "Ү": "Y", "ү": "y", "Ԍ": "G", "ԍ": "g", "ӏ": "l", "Ӏ": "I", "ɡ": "g", "ı": "i", "ɑ": "a",
    "Ϲ": "C", "ϲ": "c", "ϳ": "j", "Ϳ": "J",
}

# Kana that look like an ideograph.
KANA = {"カ": "力", "ニ": "二", "ロ": "口", "エ": "工", "タ": "夕", "ト": "卜", "ハ": "八"}

# Radical signs whose compatibility mapping the character database leaves out.
RADICALS = {
    "⺀": "冫", "⺁": "厂", "⺃": "乚", "⺅": "亻", "⺆": "冂", "⺉": "刂", "⺋": "㔾", "⺎": "兀", "⺏": "尣", "⺐": "尢", "⺒": "巳",
    "⺓": "幺", "⺔": "彑", "⺖": "忄", "⺗": "㣺", "⺘": "扌", "⺙": "攵", "⺛": "旡", "⺝": "月", "⺞": "歺", "⺠": "民", "⺡": "氵",
    "⺢": "氺", "⺣": "灬", "⺤": "爫", "⺥": "爫", "⺦": "丬", "⺨": "犭", "⺩": "王", "⺪": "疋", "⺬": "示", "⺭": "礻", "⺮": "竹",
    "⺯": "糹", "⺰": "纟", "⺱": "罓", "⺲": "罒", "⺴": "罓", "⺶": "羊", "⺷": "羊", "⺸": "羊", "⺹": "耂", "⺻": "肀", "⺼": "月", "⺽": "臼",
    "⺾": "艹", "⺿": "艹", "⻀": "艹", "⻁": "虎", "⻂": "衤", "⻃": "覀", "⻄": "西", "⻅": "见", "⻆": "角", "⻇": "角", "⻈": "讠",
    "⻉": "贝", "⻊": "足", "⻋": "车", "⻌": "辶", "⻍": "辶", "⻎": "辶", "⻏": "阝", "⻐": "钅", "⻑": "長", "⻒": "镸", "⻓": "长", "⻔": "门",
    "⻖": "阝", "⻗": "雨", "⻘": "青", "⻙": "韦", "⻚": "页", "⻛": "风", "⻜": "飞", "⻝": "食", "⻟": "飠", "⻠": "饣", "⻡": "首", "⻢": "马",
    "⻣": "骨", "⻤": "鬼", "⻥": "鱼", "⻦": "鸟", "⻧": "卤", "⻨": "麦", "⻩": "黄", "⻪": "黾", "⻫": "斉", "⻬": "齐", "⻭": "歯", "⻮": "齿",
    "⻯": "竜", "⻰": "龙", "⻱": "龜", "⻲": "亀",
}

DASHES = "-­‐‑‒–—―−─━⸺⸻﹘﹣－⁃ー".replace("­", "").replace("ー", "")
DOTS = "·•‧∙⋅・･·․●".replace("․", "").replace("●", "")
WAVES = "~〜∼～"
#: Invisible though not of category Cf: fillers, joiners, variation selectors, the empty Braille cell.
UNSEEN = [0x34F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x2800, 0x3164, 0xFFA0, *range(0x180B, 0x1810), *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)]


def _apart(ch: str) -> bool:
    d = unicodedata.decomposition(ch)
    return d.startswith(APART)


def _plain(ch: str) -> str:
    """Full decomposition of one character, stopping at those that look different."""
    d = unicodedata.decomposition(ch)
    if not d or d.startswith(APART):
        return ch
    parts = d.split()
    if parts[0][0] == "<":
        parts = parts[1:]
    return "".join(_plain(chr(int(p, 16))) for p in parts)


class _Table(dict):
    """``str.translate`` raises and catches an error for each missing code point; remembering it makes this ten times faster."""

    def __missing__(self, cp: int) -> int:
        self[cp] = cp
        return cp


@lru_cache(1)
def fold_table() -> dict[int, str | int | None]:
    """Code point to its folded form (None: deleted), from the character database and the lists above."""
    alike = {**ALIKE, **KANA, **RADICALS, **{c: "—" for c in DASHES}, **{c: "·" for c in DOTS}, **{c: "~" for c in WAVES}, "∶": ":"}
    out = _Table()
    for cp in (*range(0x3400), *range(0xA000, 0xAC00), *range(0xF900, 0x10000), *range(0x1D400, 0x1D800), *range(0x1F100, 0x1F200), *range(0x2F800, 0x2FA20)):
        ch = chr(cp)
        if unicodedata.category(ch) in ("Cf", "Zs", "Zl", "Zp", "Cc"):
            out[cp] = None
            continue
        to = "".join(alike.get(c, c) for c in _plain(alike.get(ch, ch)))
        to = "".join(c for c in to if unicodedata.category(c) != "Zs")
        if to != ch:
            out[cp] = to or None
    for cp in (*range(0xE0000, 0xE0080), *UNSEEN):
        out[cp] = None
    return out


def look_key(s: str | None) -> str | None:
    if s is None:
        return None
    return unicodedata.normalize("NFC", s.translate(fold_table()))


@F.pandas_udf(T.StringType())
def look_key_udf(s: pd.Series) -> pd.Series:
    table, form = fold_table(), unicodedata.normalize
    return s.map(lambda x: None if x is None else form("NFC", x.translate(table)))


def look_key_col(c: Column) -> Column:
    """Arrow expression of ``look_key``; ASCII-only and other plain texts pay only one C-level translation."""
    return look_key_udf(c)


@F.pandas_udf(T.StringType())
def normal_form(s: pd.Series, form: pd.Series) -> pd.Series:
    """Unicode normal form by name (NFC, NFD, NFKC, NFKD), which Spark has no built-in for. Null stays null."""
    return pd.Series([None if x is None else unicodedata.normalize(f, x) for x, f in zip(s, form)], dtype=object)
