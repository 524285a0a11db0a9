"""Numbering rows of groups of any size: within cells first, with the cells' sums added up over a small table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rank_within(df: DataFrame, by: list[str], cell: Column, order: list, name: str = "rank") -> DataFrame:
    """df with the row number of each row in its group ``by``, ordered by the cell (nulls last) and then ``order``.

    A task sorts one cell of a group, never a whole group; the cells of a group are added up in one small window.
    Null groups are a group of their own.
    """
    rows = df.withColumn("_cell", cell).withColumn("_none", F.col("_cell").isNull())
    keys = [*by, "_none", "_cell"]
    cells = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*by).orderBy("_none", "_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(*[F.col(k).alias(f"{k}_") for k in keys], F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    rows = rows.withColumn("_own", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    same = [rows[k].eqNullSafe(cells[f"{k}_"]) for k in keys]
    on = same[0]
    for s in same[1:]:
        on = on & s
    return rows.join(cells, on).select(*df.columns, (F.col("_base") + F.col("_own")).cast("bigint").alias(name))
