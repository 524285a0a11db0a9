"""Problem 2 over bank."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemforge.llm.scan_repair import repair
from stemforge.session import table

def _repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    bank = table(spark, sf_dir, "bank")
    names = bank.select(F.explode(F.array("subject", "exam")).alias("name")).where("length(name) > 1").distinct().collect()  # all of them: subjects and exams are dimensions
    return repair(bank.select("row_id", "stem"), "row_id", "stem", table(spark, sf_dir, "proof_stems").select("row_id", "stem"), [r["name"] for r in names])


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _repaired(spark, sf_dir).select("row_id", F.explode("kinds").alias("kind"))


def p2_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, text): every stem as continuous text."""
    return _repaired(spark, sf_dir).select("row_id", "text")


QUERIES = {"p2_found": p2_found, "p2_text": p2_text}
