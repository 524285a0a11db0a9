"""Repair of text from scanned pages: layout first, then the noisy channel.

Kinds of noise: ``header`` (running headers and footers), ``pageno`` (a page number alone), ``hyphen`` (a word split at
a line end by a hyphen that isn't its own), ``break`` (another line break inside a sentence), ``glyph`` (a misrecognised
or unreadable character). Null texts have no kinds and repair to null; empty and blank texts have none and become ''.
Texts of any length are processed whole, row by row; the corpus' counts cover all rows and have a fixed size.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemforge.llm.noisy_channel import SLOTS, Channel, Reader, align, count_texts, learn_rates
from stemforge.llm.scan_layout import Furniture, parse, seams
from stemforge.session import cut

SLICES = 64
#: Confusions rarer than this among the occurrences of the true string are not learned.
LEAST_RATE = 1e-5


def count_table(texts: DataFrame, names: list[str], asked: str | None = None) -> np.ndarray:
    """Counts of all lines of ``text`` as (2, SLOTS) numbers, 32 MB at any size of the corpus. Partitions send what isn't zero, merged as a stream by slice."""
    span = 2 * SLOTS // SLICES

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        furniture = Furniture(names)
        lines = ("\n".join(parse(t, furniture).lines) for pdf in batches for t in pdf["text"] if t)
        for k, x in enumerate(count_texts(lines, asked).reshape(SLICES, -1)):
            at = np.flatnonzero(x).astype(np.int32)
            if len(at):
                yield pd.DataFrame({"slice": [k], "at": [at.tobytes()], "n": [x[at].tobytes()]})

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for pdf in batches:
            for k, a, n in zip(pdf["slice"], pdf["at"], pdf["n"]):
                sums.setdefault(k, np.zeros(span, np.int64))[np.frombuffer(a, np.int32)] += np.frombuffer(n, np.int64)
        for k, x in sums.items():
            yield pd.DataFrame({"slice": [k], "n": [np.minimum(x, 2**31 - 1).astype(np.int32).tobytes()]})

    parts = texts.where("text is not null").select("text").mapInPandas(count, "slice int, at binary, n binary")
    out = np.zeros((SLICES, span), np.int32)
    for r in parts.repartition("slice").mapInPandas(add, "slice int, n binary").collect():  # 64 rows of 512 KB
        out[r["slice"]] = np.frombuffer(r["n"], np.int32)
    return out.reshape(2, SLOTS)


def fit_channel(pairs: DataFrame, names: list[str], least_rate: float = LEAST_RATE) -> Channel:
    """Confusion rates from (text, proof) pairs, of all confusions found more than once and at least at ``least_rate``.

    What reaches the driver is one row per such confusion: at most 1 / least_rate for each short true string.
    """

    def aligned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        furniture = Furniture(names)
        found: Counter = Counter()
        for pdf in batches:
            for text, proof in zip(pdf["text"], pdf["proof"]):
                if text and proof:
                    found.update(("", proof[i : i + k]) for k in (1, 2) for i in range(len(proof) - k + 1))
                    found.update(align(seams(parse(text, furniture).lines, lambda w: 0)[0], proof))
        yield pd.DataFrame([(a, b, n) for (a, b), n in found.items()], columns=["seen", "true", "n"])

    rows = cut(pairs.mapInPandas(aligned, "seen string, true string, n bigint").groupBy("seen", "true").agg(F.sum("n").alias("n")))
    confused = rows.where("seen <> '' and n > 1").withColumnRenamed("n", "k")
    rates = confused.join(rows.where("seen = ''").select("true", "n"), "true", "left").where(F.col("k") >= least_rate * F.coalesce("n", F.lit(1)))
    found = rates.select("seen", "true", "k", F.coalesce("n", F.lit(1)).alias("n")).collect()
    return Channel(learn_rates({(r["seen"], r["true"]): r["k"] for r in found}, {r["true"]: r["n"] for r in found}))


def repair(rows: DataFrame, id_column: str, text_column: str, proof: DataFrame | None = None, names: list[str] | None = None) -> DataFrame:
    """(id_column, text, kinds ARRAY<STRING>): the repaired text of each row and the kinds of noise found in it.

    proof: optional (id_column, text_column) proofread texts, from which confusion rates are learned; without them the
    fixed list and its prior rate are used. names: subjects and exams that headers may name.
    """
    spark = rows.sparkSession
    names = sorted(names or [])
    texts = rows.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    channel = Channel({})
    if proof is not None:
        known = proof.select(F.col(id_column).alias("id"), F.col(text_column).alias("proof"))
        channel = fit_channel(texts.join(known, "id").select("text", "proof"), names)
    table = spark.sparkContext.broadcast(count_table(texts, names, channel.asked))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        furniture, reader = Furniture(names), Reader(table.value, channel)
        for pdf in batches:
            out = []
            for i, text in zip(pdf["id"], pdf["text"]):
                if text is None:
                    out.append((i, None, []))
                    continue
                page = parse(text, furniture)
                joined, kinds = seams(page.lines, reader.known)
                joined, wrong = reader.read(joined)
                kinds |= {k for k, v in (("header", page.headers), ("pageno", page.pages), ("glyph", wrong)) if v}
                out.append((i, joined, sorted(kinds)))
            yield pd.DataFrame(out, columns=["id", "text", "kinds"])

    kind = dict(rows.dtypes)[id_column]
    return texts.mapInPandas(read, f"id {kind}, text string, kinds array<string>").withColumnRenamed("id", id_column)
