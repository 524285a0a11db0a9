"""Mixing sources to target shares of the total size by systematic sampling.

Each record of a source is expected to be used e times, e being the source's share of the wanted total over its
size, and at most its cap of repeats. Records are ordered within their source by size (so that sizes are spread
evenly) and a hash; the running sum of e plus one random offset per source crosses whole numbers, and a record is used
once per number crossed: floor(e) or ceil(e) times, never more than the cap.

The running sum needs no global sort: records are counted per cell (source, class of size, slice of the hash), the
cells' sums are added up over a table of bounded size, and only within cells are records numbered. A source's
slices grow with its records, so one with a third of all rows has as many more cells.

Records without size, source or target are left out. A target without records can't be met: its share is spread over
the others in proportion, and the report has both its target and what was reached.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stemforge.session import broadcast_below, cut

#: Classes per doubling of size; records of a source per hash slice of its classes.
FINE, SLICE = 8, 500_000


def plan(sizes: DataFrame, targets: DataFrame, total: float | None = None) -> DataFrame:
    """(source, target_share, max_repeats, records, size, expected, wanted): one row per target. Equal rows count once; different ones of a source add up.

    total: the wanted total size; by default the largest that all targets with records can meet within their caps.
    """
    have = sizes.where("tokens > 0 and source is not null").groupBy("source").agg(F.count("*").alias("records"), F.sum("tokens").alias("size"))
    t = targets.select("source", "target_share", "max_repeats").where("source is not null and target_share > 0 and max_repeats > 0").distinct().groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    t = t.join(have, "source", "left")
    live = t.where("size > 0")
    some = live.agg(F.sum("target_share").alias("live_share"))
    t = t.crossJoin(F.broadcast(some)).withColumn("share", F.when(F.col("size") > 0, F.col("target_share") / F.col("live_share")))
    most = t.agg(F.min(F.col("max_repeats") * F.col("size") / F.col("share")).alias("most"))  # one row
    t = t.crossJoin(F.broadcast(most)).withColumn("wanted", F.col("share") * (F.lit(float(total)) if total else F.col("most")))
    e = F.least(F.col("wanted") / F.col("size"), F.col("max_repeats").cast("double"))
    return cut(t.select("source", "target_share", "max_repeats", F.coalesce("records", F.lit(0)).alias("records"), F.coalesce("size", F.lit(0)).alias("size"), F.coalesce(e, F.lit(0.0)).alias("expected"), F.coalesce("wanted", F.lit(0.0)).alias("wanted")))  # one row per target


def sample(sizes: DataFrame, planned: DataFrame, seed: int = 7) -> DataFrame:
    """(doc_id, source, tokens, copies) of the records used at least once, for sizes (doc_id, source, tokens)."""
    w = broadcast_below(planned.where("expected > 0").select("source", "expected", F.ceil(F.col("records") / SLICE).cast("int").alias("slices")))
    rows = sizes.where("tokens > 0").select("doc_id", "source", F.col("tokens").cast("bigint").alias("tokens"))
    rows = rows.withColumn("h", F.xxhash64(F.lit(seed), "doc_id")).withColumn("class", F.floor(F.log2("tokens") * FINE).cast("int"))
    rows = rows.join(w, "source").withColumn("slice", F.pmod(F.shiftrightunsigned("h", 32), F.col("slices")).cast("int"))
    cells = rows.groupBy("source", "class", "slice").agg(F.count("*").alias("n"))
    before = Window.partitionBy("source").orderBy("class", "slice").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("source", "class", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("source", "class", "slice").orderBy("tokens", "h", "doc_id")))
    ranked = ranked.join(cells, ["source", "class", "slice"])
    offset = F.pmod(F.xxhash64(F.lit(seed), "source"), F.lit(2**20)) / F.lit(float(2**20))
    at = lambda k: F.floor((F.col("base") + F.col("rank") - k) * F.col("expected") + offset + 1e-9)
    return ranked.select("doc_id", "source", "tokens", (at(0) - at(1)).cast("int").alias("copies")).where("copies > 0")


def shares(planned: DataFrame, used: DataFrame) -> DataFrame:
    """(source, target_share, actual_share, max_repeats, records, used_records, most_copies, tokens): the shares reached."""
    got = used.groupBy("source").agg(F.count("*").alias("used_records"), F.max("copies").alias("most_copies"), F.sum(F.col("tokens") * F.col("copies")).alias("tokens"))
    total = used.agg(F.sum(F.col("tokens") * F.col("copies")).alias("total"))
    out = planned.join(got, "source", "left").crossJoin(F.broadcast(total))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return out.select("source", "target_share", F.coalesce(F.col("tokens") / F.col("total"), F.lit(0.0)).alias("actual_share"), "max_repeats", "records", zero("used_records"), zero("most_copies"), zero("tokens"))


def largest_error(report: DataFrame) -> float:
    """The greatest distance of a reached share from its target, among targets with records."""
    r = report.where("records > 0").agg(F.max(F.abs(F.col("actual_share") - F.col("target_share"))).alias("e")).first()
    return math.nan if r is None or r["e"] is None else float(r["e"])
