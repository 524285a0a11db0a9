"""Quality gates over question tables: every gate reports its denominator, and absence is a state of its own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Statuses of answers that can be graded, and of those that can only be read.
ANSWERABLE = ("official", "multi", "free")
READ_ONLY = ("none_published", "not_applicable", "unread")
#: Numbers that a group of questions may span.
GROUP_SPAN = 10


def paper_of(qid: Column) -> Column:
    """The paper a question belongs to: its id without the last part, found by shape."""
    return F.regexp_extract(qid, r"^(.*)_\d+\z", 1)


def completeness(rows: DataFrame, paper: str, no: str) -> DataFrame:
    """(paper, rows, declared, missing, gaps): numbers 1..max that a paper lacks, as ranges, so that one corrupt number costs nothing. One shuffle on the paper."""
    g = rows.where(F.col(paper).isNotNull() & F.col(no).isNotNull()).groupBy(paper).agg(F.countDistinct(no).alias("rows"), F.max(no).alias("declared"), F.array_sort(F.collect_set(F.when(F.col(no) > 0, F.col(no)))).alias("_have"))
    before = F.concat(F.array(F.lit(0)), F.col("_have"))
    spans = F.filter(F.zip_with(before, "_have", lambda a, b: F.struct((a + 1).alias("a"), (b - 1).alias("b"))), lambda s: s["a"] <= s["b"])
    text = F.transform(spans, lambda s: F.when(s["a"] == s["b"], s["a"].cast("string")).otherwise(F.concat(s["a"].cast("string"), F.lit("-"), s["b"].cast("string"))))
    missing = F.aggregate(spans, F.lit(0).cast("bigint"), lambda n, s: n + (s["b"] - s["a"] + 1).cast("bigint"))
    return g.select(paper, "rows", "declared", missing.alias("missing"), F.array_join(text, ",").alias("gaps"))


def pairing(bank: DataFrame, key: DataFrame, on: str, value: str) -> DataFrame:
    """(on, bank value, key value, state): match, mismatch, key_missing or bank_missing; a missing key is never a mismatch."""
    b = bank.select(on, F.col(value).alias("bank_value"), F.lit(True).alias("_b"))
    k = key.select(on, F.col(value).alias("key_value"), F.lit(True).alias("_k"))
    state = F.when(F.col("_b").isNull(), "bank_missing").when(F.col("_k").isNull(), "key_missing").when(F.col("bank_value").eqNullSafe(F.col("key_value")), "match").otherwise("mismatch")
    return b.join(k, on, "full_outer").select(on, "bank_value", "key_value", state.alias("state"))


def mode_invariant(rows: DataFrame, group: str, value: str) -> DataFrame:
    """(group, mode, rows, conform): how many rows have their group's most frequent value, the least on a tie. Two aggregations, no join back."""
    counts = rows.where(F.col(group).isNotNull() & F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("_n"))
    return counts.groupBy(group).agg(F.max_by(value, F.struct("_n", -F.col(value))).alias("mode"), F.sum("_n").alias("rows"), F.max("_n").alias("conform"))


def share_guard(rows: DataFrame, group: str, bad: Column, most: float = 0.5) -> DataFrame:
    """(group, rows, bad, over): groups where the bad rows' share exceeds the limit."""
    g = rows.groupBy(group).agg(F.count("*").alias("rows"), F.count_if(bad).alias("bad"))
    return g.select(group, "rows", "bad", (F.col("bad") > most * F.col("rows")).alias("over"))


def coverage(have: DataFrame, total: list[DataFrame], key: str, by: list[str]) -> DataFrame:
    """(by, total, have): the denominator is the union of all stores' keys."""
    union = total[0].select(key, *by)
    for t in total[1:]:
        union = union.unionByName(t.select(key, *by))
    union = union.where(F.col(key).isNotNull()).distinct()
    flagged = union.join(have.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_h", F.lit(1)), key, "left")
    return flagged.groupBy(*by).agg(F.count("*").alias("total"), F.count("_h").alias("have"))


def reconcile(chunk_in: DataFrame, chunk_out: DataFrame, chunk: str, key: str) -> DataFrame:
    """(chunk, expected, done, missing, foreign, repeated): a chunk is done when the keys that went in are among those that came out."""
    a = chunk_in.groupBy(chunk, key).agg(F.count("*").alias("i"))
    b = chunk_out.groupBy(chunk, key).agg(F.count("*").alias("o"))
    j = a.join(b, [chunk, key], "full_outer")
    return j.groupBy(chunk).agg(F.count("i").alias("expected"), F.count_if(F.col("i").isNotNull() & F.col("o").isNotNull()).alias("done"), F.count_if(F.col("o").isNull()).alias("missing"), F.count_if(F.col("i").isNull()).alias("foreign"), F.count_if(F.col("o") > 1).alias("repeated"))


def breaker(rows: DataFrame, group: str, hit: Column, least: int = 1) -> DataFrame:
    """(group, n, hits, tripped): shares of 0 or 1 are suspect."""
    g = rows.groupBy(group).agg(F.count("*").alias("n"), F.count_if(hit).alias("hits"))
    return g.select(group, "n", "hits", ((F.col("n") >= least) & ((F.col("hits") == 0) | (F.col("hits") == F.col("n")))).alias("tripped"))


def asof_before(left: DataFrame, right: DataFrame, by: str, at: str, value: str) -> DataFrame:
    """left with the last right ``value`` at or before its time: both sides in one ordered window, one shuffle. Hot keys are split by day: the last value of all days before is carried over."""
    day = F.to_date(F.col(at))
    r = right.where(F.col(by).isNotNull() & F.col(at).isNotNull()).groupBy(by, at).agg(F.max(value).alias("_v"))
    l = left.where(F.col(by).isNotNull() & F.col(at).isNotNull())
    cols = [c for c in left.columns]
    both = l.select(*cols, F.lit(None).cast(dict(r.dtypes)["_v"]).alias("_v"), F.lit(1).alias("_side")).unionByName(r.select(by, at, "_v", F.lit(0).alias("_side")), allowMissingColumns=True).withColumn("_day", day)
    days = both.groupBy(by, "_day").agg(F.max_by("_v", F.when(F.col("_side") == 0, F.col(at))).alias("_last"))
    carry = days.withColumn("_carry", F.last("_last", True).over(Window.partitionBy(by).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)))
    inside = F.last("_v", True).over(Window.partitionBy(by, "_day").orderBy(at, "_side").rowsBetween(Window.unboundedPreceding, 0))
    out = both.withColumn("_inside", inside).where("_side = 1").join(carry.select(by, "_day", "_carry"), [by, "_day"])
    return out.select(*cols, F.coalesce("_inside", "_carry").alias(value))


def grade(chosen: Column, answer: Column, accept: Column, status: Column, several: str = "exact") -> Column:
    """Whether a chosen set of letters is right: official by the answer, multi by any of accept, free always; null where the status can't be graded.

    ``several`` says what an official answer of several letters means, which is never inferred: exact (all of them) or any.
    """
    if several not in ("exact", "any"):
        raise ValueError(several)
    same = chosen == answer if several == "exact" else F.contains(answer, chosen)
    return F.when(status == "official", same).when(status == "multi", F.coalesce(F.array_contains(accept, chosen), F.lit(False))).when(status == "free", F.lit(True))
