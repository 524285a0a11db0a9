"""Problem 8 over documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemforge.llm.areas import classify, train
from stemforge.session import table


def _areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "area_labels")
    areas = [r["area"] for r in table(spark, sf_dir, "areas").select("area").orderBy("area").collect()]  # 14 rows at any scale
    return classify(documents, train(documents, labels, areas))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _areas(spark, sf_dir).select("doc_id", "area")


def p8_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(area, docs): how many documents have each area."""
    return _areas(spark, sf_dir).groupBy("area").agg(F.count("*").alias("docs"))


QUERIES = {"p8_found": p8_found, "p8_composition": p8_composition}
