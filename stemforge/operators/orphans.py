"""References to records that aren't there: signed counts per key, kept from change deltas, and the rows behind them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stemforge.functions.numerals import ascii_width


def reference_key(c: Column) -> Column:
    """Keys that differ only by surrounding blanks, character width or letter case are the same; empty ones become null."""
    trimmed = F.regexp_replace(ascii_width(c), r"^[\s ​﻿]+|[\s ​﻿]+$", "")
    return F.nullif(F.lower(trimmed), F.lit(""))


_SIGNED = {"refs": F.sum, "alive": F.sum, "existed": F.sum, "born": F.min, "gone": F.max, "first_ref": F.min, "last_ref": F.max}


def apply_deltas(state: DataFrame | None, deltas: DataFrame) -> DataFrame:
    """The ledger (target, key, refs, alive, existed, born, gone, first_ref, last_ref) after signed deltas (target, key, refs, alive, at).

    refs and alive are sums of signs: of references made and withdrawn, of records made and ended; existed counts records
    ever made. born is the earliest making, gone the latest end, first_ref and last_ref bound the references' times.
    Deltas may come in any order and number, also ends before makings; the result is the same. Keys with nothing but
    zeros leave; null keys are left out, null times count without a time.
    """
    at = lambda c: F.when(c, F.col("at"))
    own = deltas.where("key is not null").select(
        "target", "key", F.col("refs").cast("bigint").alias("refs"), F.col("alive").cast("bigint").alias("alive"), F.greatest("alive", F.lit(0)).cast("bigint").alias("existed"),
        at(F.col("alive") > 0).alias("born"), at(F.col("alive") < 0).alias("gone"), at(F.col("refs") > 0).alias("first_ref"), at(F.col("refs") > 0).alias("last_ref"),
    )
    if state is not None:
        own = state.select("target", "key", *_SIGNED).unionByName(own)
    return own.groupBy("target", "key").agg(*[f(c).alias(c) for c, f in _SIGNED.items()]).where("refs <> 0 or alive <> 0 or existed <> 0")


class Ledger:
    """The ledger in a folder that executors share, a version per delivery; only the newest two stay."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.version = spark, path.rstrip("/"), -1
        while self._fs(0).exists(self._at(self.version + 1, "/_SUCCESS")):
            self.version += 1
        # Older versions are gone after a while, so look for the newest from where one stands.
        marks = self._fs(0).globStatus(self._at("*", "/_SUCCESS")) or []
        self.version = max([self.version, *(int(m.getPath().getParent().getName()) for m in marks)])

    def _at(self, version: int | str, rest: str = ""):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{version}{rest}")

    def _fs(self, version: int):
        return self._at(version).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def read(self) -> DataFrame | None:
        return self.spark.read.parquet(f"{self.path}/{self.version}") if self.version >= 0 else None

    def advance(self, deltas: DataFrame) -> DataFrame:
        """Apply a delivery's deltas, write the next version and return it as read back."""
        apply_deltas(self.read(), deltas).write.mode("overwrite").parquet(f"{self.path}/{self.version + 1}")
        self.version += 1
        self._fs(0).delete(self._at(self.version - 2), True)
        return self.read()


def orphan_keys(ledger: DataFrame) -> DataFrame:
    """The current orphan report: keys that are referred to and don't exist."""
    return ledger.where("refs > 0 and alive <= 0")


def ever_orphans(ledger: DataFrame) -> DataFrame:
    """Keys with positive references of which some may have been made while the existence count was zero: before the first record or after the end of the last, or without any."""
    return ledger.where("refs > 0 and (existed = 0 or first_ref < born or (alive <= 0 and last_ref >= gone))")


def reference_deltas(refs: DataFrame) -> DataFrame:
    return refs.select("target", "key", F.lit(1).alias("refs"), F.lit(0).alias("alive"), "at")


def existence_deltas(targets: DataFrame) -> DataFrame:
    """targets (target, key, born, gone): a record is made at born and, unless gone is null, ends then."""
    deltas = F.array(F.struct(F.lit(1).alias("alive"), F.col("born").alias("at")), F.struct(F.lit(-1).alias("alive"), F.col("gone").alias("at")))
    live = F.filter(deltas, lambda d: (d["alive"] > 0) | d["at"].isNotNull())
    return targets.select("target", "key", F.explode(live).alias("d")).select("target", "key", F.lit(0).alias("refs"), F.col("d.alive").alias("alive"), F.col("d.at").alias("at"))


def orphan_references(refs: DataFrame, ledger: DataFrame, salt: int = 16, hot_share: float = 0.005) -> DataFrame:
    """The references (src_table, src_id, target, key, at) behind the ledger's orphan keys, with the reason.

    The keys come from the ledger's counts; a reference to one of them is checked at its time. reason: ``missing`` no
    record was ever made; ``late`` before the first was; ``deleted`` at or after the end of the last. A null time can only
    be missing. Null keys are no case. Keys with more than ``hot_share`` of all references (so at most 1 / hot_share)
    are spread over ``salt`` partitions, their ledger rows copied to each.
    """
    keys = ever_orphans(ledger).select("target", "key", "refs", "alive", "existed", "born", "gone")
    most = (ledger.agg(F.sum("refs")).first()[0] or 0) * hot_share
    hot = keys.where(F.col("refs") > most).select("target", "key", F.lit(salt).alias("_salts"))
    refs = refs.where("key is not null").join(F.broadcast(hot), ["target", "key"], "left")
    refs = refs.withColumn("_salt", F.coalesce(F.pmod(F.xxhash64("src_table", "src_id"), F.col("_salts")).cast("int"), F.lit(0))).drop("_salts")
    keys = keys.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.when(F.col("refs") > most, salt - 1).otherwise(0)))).drop("refs")
    joined = refs.join(keys, ["target", "key", "_salt"])
    reason = F.when(F.col("existed") == 0, "missing").when(F.col("at") < F.col("born"), "late").when((F.col("alive") <= 0) & (F.col("at") >= F.col("gone")), "deleted")
    return joined.withColumn("reason", reason).where("reason is not null").select("src_table", "src_id", "target", "key", "at", "reason")
