"""Pairs within groups of any size: a group's members are spread over blocks, and a task joins two blocks at a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def grouped_pairs(df: DataFrame, key: str, item: str, differ: Column | None = None, block: int = 1_000) -> DataFrame:
    """(key, a, b): each pair of ``item`` structs with the same ``key`` once, where ``differ`` (over columns a and b) holds.

    Groups beyond ``block`` members are split into blocks by a hash of the item, so that a group holding a third of
    all rows is joined by many tasks. Null keys make no pairs.
    """
    sized = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_c")).where("_c > 1").select(key, F.ceil(F.col("_c") / block).cast("int").alias("_n"))
    rows = df.join(sized, key).withColumn("_b", F.pmod(F.xxhash64(F.to_json(item)), F.col("_n")).cast("int"))
    left = rows.select(key, F.col(item).alias("a"), F.col("_b").alias("_i"), F.explode(F.sequence("_b", F.col("_n") - 1)).alias("_j"))
    right = rows.select(key, F.col(item).alias("b"), F.explode(F.sequence(F.lit(0), F.col("_b"))).alias("_i"), F.col("_b").alias("_j"))
    pairs = left.join(right, [key, "_i", "_j"]).where((F.col("_i") != F.col("_j")) | (F.col("a") < F.col("b")))
    return (pairs if differ is None else pairs.where(differ)).select(key, "a", "b")


def expand_pairs(pairs: DataFrame, members: DataFrame, key: str, item: str, block: int = 1_000) -> DataFrame:
    """(a, b): members of each pair of keys (a, b); of a pair of a key with itself, each two of its members once.

    pairs (a, b) are distinct; members (key, item) too. Keys beyond ``block`` members are split into blocks by a hash of
    the item, and the pairs of blocks are joined, so no task gets a whole hot key. Null keys and items make no pairs.
    """
    members = members.where(F.col(key).isNotNull() & F.col(item).isNotNull()).select(F.col(key).alias("_k"), F.col(item).alias("_m"))
    hot = members.groupBy("_k").agg(F.ceil(F.count("*") / block).cast("int").alias("_n")).where("_n > 1")
    if hot.isEmpty():  # nothing to split: two joins
        left, right = (members.select(F.col("_k").alias(side), F.col("_m").alias(name)) for side, name in (("a", "_x"), ("b", "_y")))
        out = pairs.join(left, "a").join(right, "b").where("a <> b or _x < _y")
        return out.select(F.col("_x").alias("a"), F.col("_y").alias("b"))
    one = F.coalesce(F.col("_n"), F.lit(1))
    cells = members.join(hot, "_k", "left").select("_k", F.pmod(F.xxhash64("_m"), one).cast("int").alias("_b"), "_m")
    for side, at in (("a", "_i"), ("b", "_j")):
        pairs = pairs.join(hot.withColumnRenamed("_k", side), side, "left").withColumn(at, F.explode(F.sequence(F.lit(0), one - 1))).drop("_n")
    pairs = pairs.where("a <> b or _i <= _j")
    left = cells.select(F.col("_k").alias("a"), F.col("_b").alias("_i"), F.col("_m").alias("_x"))
    right = cells.select(F.col("_k").alias("b"), F.col("_b").alias("_j"), F.col("_m").alias("_y"))
    out = pairs.join(left, ["a", "_i"]).join(right, ["b", "_j"]).where("a <> b or _i <> _j or _x < _y")
    return out.select(F.col("_x").alias("a"), F.col("_y").alias("b"))
