"""One consistent form for texts that look the same: Viterbi search in look-alike lattices.

A text is first folded (compatibility forms, composed accents, ignorable characters and blanks deleted). Each letter
of the fold stands for a class of letters that look alike, such as Latin, Cyrillic and Greek capital A, or katakana ka
and the ideograph for power. The form written out takes one letter of each class, by Viterbi over the lattice of a run
of letters: character bigram scores learned from the stored runs, with a price for changing script inside a run. So a
Latin word that was stored with a Cyrillic o comes out all Latin, a Cyrillic word stays Cyrillic, and a katakana word
keeps its kana.

The lattice depends on the fold alone and the classes are disjoint, so two texts get the same form exactly if they
look the same, whatever the scores are.

Null gives null, empty and blank texts give ''. Every character of a text of any length is processed.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stemforge.functions.lookalike import ALIKE, KANA, fold_table

EDGE = "^"
_IDEOGRAPHS = "".join(KANA.values())
#: Runs that are decoded: words of alphabets, and katakana with the ideographs that look like kana.
WORD = rf"[\p{{IsLatin}}\p{{IsCyrillic}}\p{{IsGreek}}\p{{IsArmenian}}]+|[\p{{IsKatakana}}ー{_IDEOGRAPHS}]+"
SCRIPT_PRICE = 6.0


@lru_cache(1)
def classes() -> dict[str, str]:
    """Folded letter to the letters that look like it, itself first."""
    out: dict[str, str] = {}
    for letter, to in {**ALIKE, **KANA}.items():
        out[to] = out.get(to, to) + letter
    return out


@lru_cache(4096)
def script(ch: str) -> str:
    return unicodedata.name(ch, "?").split(" ")[0] if ch.isalpha() else "-"


def bigram_counts(texts: DataFrame, column: str) -> DataFrame:
    """(a, b, n): bigrams, with edges, of all runs in a text column, and with b null all that begin with a; counted in the JVM with partial aggregation.

    Only bigrams with a letter that has look-alikes can decide anything. With those letters and the five scripts being
    finite parts of the character set, the rows are too, whatever the texts.
    """
    words = texts.select(F.explode(F.regexp_extract_all(F.col(column), F.lit(f"({WORD})"), 1)).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    edged = F.concat(F.lit(EDGE), "w", F.lit(EDGE))
    pairs = words.select("n", F.explode(F.transform(F.sequence(F.lit(1), F.length("w") + 1), lambda i: F.substring(edged, i, F.lit(2)))).alias("p"))
    ambiguous = f"[{''.join(sorted(set(''.join(classes().values()))))}]"
    pairs = pairs.groupBy("p").agg(F.sum("n").alias("n")).select(F.substring("p", 1, 1).alias("a"), F.substring("p", 2, 1).alias("b"), "n")
    total = pairs.groupBy("a").agg(F.sum("n").alias("n")).select("a", F.lit(None).cast("string").alias("b"), "n")
    return pairs.where(F.concat("a", "b").rlike(ambiguous)).unionByName(total)


class Scores:
    """Add-one bigram scores with the script price, built from ``bigram_counts`` rows."""

    def __init__(self, rows: Iterable[tuple[str, str | None, int]]):
        table, letters = fold_table(), set("".join(classes().values()))
        plain = lambda c: c if c in letters else table.get(ord(c), c)
        self.pair: dict[tuple[str, str], float] = defaultdict(float)
        self.first: dict[str, float] = defaultdict(float)
        for a, b, n in rows:
            x, y = plain(a), b if b is None else plain(b)
            if y is None and b is None:
                self.first[x] += n
            else:
                self.pair[x, y] += n

    def price(self, a: str, b: str) -> float:
        p = -math.log((self.pair.get((a, b), 0.0) + 0.5) / (self.first.get(a, 0.0) + 500.0))
        return p + (SCRIPT_PRICE if EDGE not in (a, b) and script(a) != script(b) else 0.0)


def decode(word: str, scores: Scores) -> str:
    """The cheapest path through the word's look-alike lattice; ties go to the earlier letter of a class."""
    by_class = classes()
    if not any(ch in by_class for ch in word):
        return word
    best: dict[str, tuple[float, str]] = {EDGE: (0.0, "")}
    for ch in word:
        step: dict[str, tuple[float, str]] = {}
        for to in by_class.get(ch, ch):
            cost, path = min(((c + scores.price(a, to), p) for a, (c, p) in best.items()), key=lambda x: x[0])
            step[to] = (cost, path + to)
        best = step
    return min(((c + scores.price(a, EDGE), p) for a, (c, p) in best.items()), key=lambda x: x[0])[1]


_RUNS = re.compile(rf"[^\W\d_⺀-\U0003ffff]+|[ァ-ヺー{_IDEOGRAPHS}]+")


def canonical_column(scores: Scores, column: Column) -> Column:
    """The consistent form of a text column. The scores, of bounded size, travel with the function."""

    def form(s: pd.Series) -> pd.Series:
        table, known = fold_table(), {}

        def run(m: re.Match) -> str:
            w = m[0]
            if w not in known:
                if len(known) > 200_000:
                    known.clear()
                known[w] = decode(w, scores)
            return known[w]

        return s.map(lambda x: None if x is None else _RUNS.sub(run, unicodedata.normalize("NFC", x.translate(table))))

    return F.pandas_udf(form, T.StringType())(column)


def fit_scores(*texts: tuple[DataFrame, str]) -> Scores:
    """Scores of all runs of the given (table, column) pairs."""
    every = None
    for df, column in texts:
        one = df.select(F.col(column).alias("text"))
        every = one if every is None else every.unionByName(one)
    rows = bigram_counts(every, "text").collect()  # pairs of letters of five scripts
    return Scores((r["a"], r["b"], r["n"]) for r in rows)
