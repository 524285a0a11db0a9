"""Keyed maintenance of tables: upserts, overlays, splices, and writes that never lose the table they replace."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stemforge.operators.snapshots import latest_rows


def upsert(old: DataFrame, new: DataFrame, key: str, order: list[str]) -> DataFrame:
    """old with new rows of the same key in their place and the others added; of several new rows the last in ``order`` counts. Column ``state``: kept, replaced or added."""
    last = latest_rows(new, [key], order).withColumn("_new", F.lit(True))
    both = old.withColumn("_old", F.lit(True)).alias("o").join(last.alias("n"), key, "full_outer")
    cols = [c for c in old.columns if c != key]
    pick = [F.when(F.col("_new"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in cols]
    state = F.when(F.col("_new").isNull(), "kept").when(F.col("_old").isNull(), "added").otherwise("replaced")
    return both.select(key, *pick, state.alias("state"))


def replace_partition(old: DataFrame, new: DataFrame, column: str, value: str) -> DataFrame:
    """old without one partition, and the new rows of it. Idempotent; rows with a null partition stay."""
    return old.where(~F.col(column).eqNullSafe(F.lit(value))).unionByName(new.where(F.col(column) == value))


def overlay(layers: list[DataFrame], key: str, value: str) -> DataFrame:
    """(key, value, layer): of several layers, given from weak to strong, the strongest that has a value."""
    stacked = None
    for i, layer in enumerate(layers):
        one = layer.select(key, F.col(value), F.lit(i).alias("layer"))
        stacked = one if stacked is None else stacked.unionByName(one)
    return stacked.where(F.col(value).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.max_by(value, F.struct("layer", F.col(value))).alias(value), F.max("layer").alias("layer"))


def splice(text: Column, index: Column, paragraph: Column) -> Column:
    """The text with one paragraph (from 1) replaced; unchanged where the index is out of range."""
    parts = F.split(text, "\n\n")
    spliced = F.array_join(F.transform(parts, lambda p, i: F.when(i + 1 == index, paragraph).otherwise(p)), "\n\n")
    return F.when((index >= 1) & (index <= F.size(parts)), spliced).otherwise(text)


def staged_write(df: DataFrame, path: str, keys: list[str] | None = None) -> None:
    """Write a parquet table in place of another: checked in a staging folder first, then renamed.

    Refuses an empty result and repeated keys, before anything is replaced. The table replaced stays as ``path.bak1``,
    ``path.bak2`` and so on; no backup is ever overwritten, and where the new table can't take its place the old one returns.
    """
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    P = jvm.org.apache.hadoop.fs.Path
    fs = P(path).getFileSystem(conf)
    stage = P(path + ".staging")
    df.write.mode("overwrite").parquet(path + ".staging")
    made = spark.read.parquet(path + ".staging")
    if made.isEmpty():
        fs.delete(stage, True)
        raise ValueError(f"an empty result doesn't replace {path}")
    if keys and not made.groupBy(*keys).count().where("count > 1").isEmpty():
        fs.delete(stage, True)
        raise ValueError(f"repeated keys {keys}: {path} stays")
    back = None
    if fs.exists(P(path)):
        back = next(b for b in (P(f"{path}.bak{k}") for k in itertools.count(1)) if not fs.exists(b))
        fs.rename(P(path), back)
    if not fs.rename(stage, P(path)):
        if back is not None:
            fs.rename(back, P(path))
        raise OSError(f"{path} couldn't be replaced")
