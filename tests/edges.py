"""Variants of the smallest tables for edge cases: empty ones, rows of nulls, repeated rows, and extra columns with clashing names."""

from __future__ import annotations

import glob
import os

from pyspark.sql import functions as F

from tests.test_queries import DATA

#: Names that operators use inside.
CLASHING = ["a", "b", "n", "k", "key", "doc", "part", "text", "size", "grp", "cell", "seq", "state", "digest", "reason", "refs", "alive", "target", "at", "stored", "form", "item", "tokens", "source_", "class", "slice", "share", "chars", "path", "areas", "_r", "_k", "_n"]
#: Tables that are dimensions or labels, which stay as they are in the variant with nulls.
UNIQUE = {"bank": "row_id", "explanations": "expl_id", "anchor_packs": "pack_row", "documents": "doc_id", "answer_events": None, "figure_files": None, "area_labels": None, "proof_stems": "row_id", "areas": None, "mix_targets": None, "container_specs": None}


def save(spark, out: str, kind: str) -> str:
    for p in glob.glob(f"{DATA}/*.parquet"):
        name = os.path.basename(p)[:-8]
        df = spark.read.parquet(p)
        if name in UNIQUE:
            if kind == "empty":
                df = df.limit(0)
            else:
                nulls = df.limit(1).select(*[F.lit(None).cast(t).alias(c) if c != UNIQUE[name] else F.lit(-1).cast(t).alias(c) for c, t in df.dtypes])
                again = df.limit(20) if UNIQUE[name] is None else df.limit(0)
                df = df.unionByName(nulls).unionByName(again)
                df = df.select(*df.columns, *[F.lit("x").alias(c) for c in CLASHING if c not in df.columns])
        df.coalesce(1).write.parquet(f"{out}/{name}.parquet")
    return out
