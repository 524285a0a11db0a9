"""Subject areas of documents: training on labelled and weakly labelled documents, scoring of all.

A document has the areas of its paragraphs. Null, empty and blank texts have none; equal texts have the same areas, as
the result depends on the text alone. The model is trained on the driver, on at most ``max_labelled`` labelled
documents of at most ``max_chars`` characters together, chosen by a hash of their ids, and on as many weakly labelled
ones; every document is scored, whole.

Weak labels come from source and the path part of origin: a rule says that documents of that source and path have an
area with the precision that the labelled sample shows. Precisions may be low; training uses that share of the rule's
documents.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from stemforge.llm.area_model import Linear, calibrate, document_areas, fit_areas

#: The bounds on the training sample, for labelled and for weakly labelled documents.
MAX_LABELLED, MAX_CHARS = 1_000, 2_000_000
#: A rule needs this precision, this many labelled documents, and to name the area so many times as often as documents do overall.
LEAST_SHARE, LEAST_DOCS, LEAST_LIFT = 0.5, 30, 3.0
CHUNK_CHARS = 300_000


def path_of(origin: str | None) -> str:
    """The path part of an origin: what stands before its first digit."""
    return re.match(r"\D*", origin or "")[0]


def weak_rules(labelled: list[tuple[str | None, str | None, set[str]]]) -> dict[tuple[str, str], dict[str, float]]:
    """(source, path) to areas with their precision, from (source, origin, areas) of labelled documents."""
    total, by_area, overall = Counter(), Counter(), Counter()
    for source, origin, have in labelled:
        overall.update(have)
        if source and path_of(origin):
            total[source, path_of(origin)] += 1
            by_area.update((source, path_of(origin), a) for a in have)
    rules: dict[tuple[str, str], dict[str, float]] = {}
    for (source, path, area), k in sorted(by_area.items()):
        n = total[source, path]
        if n >= LEAST_DOCS and k >= LEAST_SHARE * n and k / n >= LEAST_LIFT * overall[area] / len(labelled):
            rules.setdefault((source, path), {})[area] = k / n
    return rules


def _first(rows: DataFrame, most: int) -> list[Row]:
    """The first rows in the order of a hash of doc_id. A slice of the hashes is taken before, so that partitions don't each send that many."""
    share = min(1.0, 2 * most / max(1, rows.count()))
    some = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(2**31)) < share * 2**31)
    return some.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).collect()


def _sample(rows: DataFrame, ids: list[int], max_chars: int) -> list[Row]:
    """Rows (doc_id, source, origin, text) of the ids, in their order, of so many characters together; a document that doesn't fit is left out."""
    found = {r["doc_id"]: r for r in rows.where(F.col("doc_id").isin(ids)).select("doc_id", "source", "origin", F.length("text").alias("chars")).collect()} if ids else {}
    kept, left = [], max_chars
    for i in ids:
        if i in found and found[i]["chars"] <= left:
            kept.append(i)
            left -= found[i]["chars"]
    texts = {r["doc_id"]: r["text"] for r in rows.where(F.col("doc_id").isin(kept)).select("doc_id", "text").collect()} if kept else {}
    return [Row(**found[i].asDict(), text=texts[i]) for i in kept]


def train(documents: DataFrame, labels: DataFrame, areas: list[str], max_labelled: int = MAX_LABELLED, max_chars: int = MAX_CHARS) -> Linear:
    """The model of a bounded sample; a fifth of it is held out for the thresholds. Without labels the model finds no area."""
    full = documents.where("text is not null").select("doc_id", "source", "origin", "text")
    sets = labels.where("doc_id is not null and area is not null").groupBy("doc_id").agg(F.collect_set("area").alias("areas"))
    chosen = {r["doc_id"]: set(r["areas"]) for r in _first(sets, max_labelled)}
    docs = _sample(full, list(chosen), max_chars)
    model = Linear(areas)
    if not docs:
        model.b -= 100
        return model
    fifth = len(docs) // 5
    rules = weak_rules([(r["source"], r["origin"], chosen[r["doc_id"]]) for r in docs[fifth:]])
    weak: list[tuple[str, dict[str, float]]] = []
    if rules:
        names = [F.struct(F.lit(s).alias("source"), F.lit(p).alias("path")) for s, p in rules]
        found = full.where(F.struct("source", F.regexp_extract("origin", r"^(\D*)", 1).alias("path")).isin(names)).select("doc_id")
        ids = [r["doc_id"] for r in _first(found, 2 * max_labelled)]
        known = {r["doc_id"] for r in labels.where(F.col("doc_id").isin(ids)).select("doc_id").distinct().collect()}
        weak = [(r["text"], rules[r["source"], path_of(r["origin"])]) for r in _sample(full, [i for i in ids if i not in known][:max_labelled], max_chars)]
    gold = [(r["text"], chosen[r["doc_id"]]) for r in docs]
    fitted = fit_areas(gold[fifth:], areas, weak=weak)
    calibrate(fitted, gold[:fifth] or gold)
    return fitted


def classify(documents: DataFrame, model: Linear) -> DataFrame:
    """(doc_id, area) of all documents."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for pdf in batches:
            ids, texts, held = [], [], 0
            for i, t in zip(pdf["doc_id"], pdf["text"]):
                ids.append(i)
                texts.append(t)
                held += len(t)
                if held > CHUNK_CHARS:
                    yield _rows(ids, document_areas(m, texts))
                    ids, texts, held = [], [], 0
            if ids:
                yield _rows(ids, document_areas(m, texts))

    return documents.where("text is not null").select("doc_id", "text").mapInPandas(score, "doc_id bigint, area string")


def _rows(ids: list[int], found: list[list[str]]) -> pd.DataFrame:
    return pd.DataFrame({"doc_id": [i for i, a in zip(ids, found) for _ in a], "area": [x for a in found for x in a]}).astype({"doc_id": "int64", "area": "object"})
