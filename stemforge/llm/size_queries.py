"""Problems 6 and 7 over documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemforge.llm.mixing import plan, sample, shares
from stemforge.llm.packing import pack
from stemforge.llm.tokens import token_count
from stemforge.session import cut, table


def _sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, source, tokens): sizes are read several times, so they are written once."""
    return cut(table(spark, sf_dir, "documents").select("doc_id", "source", token_count(F.col("text")).alias("tokens")))


def p6_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_sizes(spark, sf_dir), table(spark, sf_dir, "container_specs"))


def p6_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(spec, containers, items, pieces, tokens, fill, by_tokens, by_documents, by_attention): how full the containers are, and which capacity is used up most in how many."""
    bins = p6_containers(spark, sf_dir).groupBy("spec", "container", "capacity_tokens").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("items"), F.count_if(F.col("piece") > 0).alias("pieces"), F.max("closed_by").alias("closed_by"))
    by = [F.count_if(F.col("closed_by") == c).alias(f"by_{c}") for c in ("tokens", "documents", "attention")]
    return bins.groupBy("spec").agg(F.count("*").alias("containers"), F.sum("items").alias("items"), F.sum("pieces").alias("pieces"), F.sum("tokens").alias("tokens"), (F.sum("tokens") / F.sum("capacity_tokens")).alias("fill"), *by)


def p7_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = _sizes(spark, sf_dir)
    return sample(sizes, plan(sizes, table(spark, sf_dir, "mix_targets")))


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = _sizes(spark, sf_dir)
    planned = plan(sizes, table(spark, sf_dir, "mix_targets"))
    return shares(planned, sample(sizes, planned))


QUERIES = {"p6_containers": p6_containers, "p6_fill": p6_fill, "p7_selected": p7_selected, "p7_shares": p7_shares}
