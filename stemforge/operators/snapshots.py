"""What changed between consecutive full snapshots, by ordinals, compressed bitmaps and aligned column vectors.

``SnapshotStore`` keeps ordinals and containers from delivery to delivery. Each key gets a persistent ordinal: a hash bucket and a position in it that later keys never disturb. A snapshot is
then one small row per container (a page of 65,536 positions of a bucket): a compressed bitmap of the positions
present, and the values' digests in the bitmap's order. Two neighbouring snapshots of a container are compared by
AND-NOT of the bitmaps (added, removed) and by the vectors over the positions in both (changed).

Containers are the unit of work: hot keys can't exist (a key occurs once a snapshot), and no task holds more than a
page of each of two snapshots.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stemforge.session import cut

PAGE = 65_536
#: Positions kept as sorted numbers up to this many, as 8 KB of bits beyond: the smaller of the two.
SPARSE = 4_096
DIGEST = 16


def key_dictionary(keys: DataFrame, known: DataFrame | None = None, per_bucket: int = 8_192, only_new: bool = False) -> DataFrame:
    """(key, bucket, pos): ordinals of the distinct non-null ``key`` values; keys of ``known`` keep theirs.

    The number of buckets is fixed by the first call and is read back from ``known`` (column ``buckets``) later, so
    ordinals persist; growth lengthens the buckets, which only adds pages. only_new: without the rows of ``known``.
    """
    fresh = keys.select("key").where("key is not null").distinct()
    if known is None:
        n = max(1, 2 ** math.ceil(math.log2(max(1, fresh.count() / per_bucket))))
        base = None
    else:
        first = known.select("buckets").first()
        if first is None:
            return key_dictionary(keys, None, per_bucket, only_new)
        n = first["buckets"]
        fresh = fresh.join(known, "key", "left_anti")
        base = known.groupBy("bucket").agg(F.max("pos").alias("last"))
    fresh = fresh.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(n)).cast("int"))
    fresh = fresh.withColumn("rank", F.row_number().over(Window.partitionBy("bucket").orderBy("key")))
    if base is None:
        return fresh.select("key", "bucket", (F.col("rank") - 1).cast("bigint").alias("pos"), F.lit(n).alias("buckets"))
    fresh = fresh.join(base, "bucket", "left").select("key", "bucket", (F.coalesce("last", F.lit(-1)) + F.col("rank")).cast("bigint").alias("pos"), F.lit(n).alias("buckets"))
    return fresh if only_new else known.select("key", "bucket", "pos", "buckets").unionByName(fresh)


def _pack(pos: np.ndarray) -> bytes:
    if len(pos) <= SPARSE:
        return b"a" + pos.astype("<u2").tobytes()
    bits = np.zeros(PAGE, bool)
    bits[pos] = True
    return b"b" + np.packbits(bits).tobytes()


def _bits(packed: bytes | None) -> np.ndarray:
    bits = np.zeros(PAGE, bool)
    if packed:
        if packed[:1] == b"a":
            bits[np.frombuffer(packed, "<u2", offset=1)] = True
        else:
            bits = np.unpackbits(np.frombuffer(packed, np.uint8, offset=1)).astype(bool)
    return bits


def _and_not(a: bytes | None, b: bytes | None) -> np.ndarray:
    """Positions in a and not in b; two sparse containers need no bits."""
    if (a or b"a")[:1] == b"a" and (b or b"a")[:1] == b"a":
        x = np.frombuffer(a, "<u2", offset=1) if a else np.zeros(0, "<u2")
        y = np.frombuffer(b, "<u2", offset=1) if b else np.zeros(0, "<u2")
        return np.setdiff1d(x, y, assume_unique=True)
    return np.flatnonzero(_bits(a) & ~_bits(b))


def _positions(packed: bytes | None) -> np.ndarray:
    if not packed:
        return np.zeros(0, np.int64)
    return np.frombuffer(packed, "<u2", offset=1).astype(np.int64) if packed[:1] == b"a" else np.flatnonzero(_bits(packed))


_CONTAINER = T.StructType([T.StructField("seq", T.IntegerType()), T.StructField("bucket", T.IntegerType()), T.StructField("page", T.LongType()), T.StructField("bitmap", T.BinaryType()), T.StructField("vector", T.BinaryType())])


def _container(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("slot")
    row = pdf.iloc[0]
    return pd.DataFrame({"seq": [row["seq"]], "bucket": [row["bucket"]], "page": [row["page"]], "bitmap": [_pack(pdf["slot"].to_numpy())], "vector": [b"".join(pdf["digest"])]})


def containers(rows: DataFrame, dictionary: DataFrame) -> DataFrame:
    """rows (seq, key, digest) to one row per snapshot and container."""
    placed = rows.join(dictionary.select("key", "bucket", "pos"), "key").select("seq", "bucket", (F.col("pos") / PAGE).cast("bigint").alias("page"), (F.col("pos") % PAGE).cast("int").alias("slot"), "digest")
    return placed.groupBy("seq", "bucket", "page").applyInPandas(_container, _CONTAINER)


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out: list[pd.DataFrame] = []
        for r in pdf.itertuples(index=False):
            for seq, old, ov, new, nv in ((r.seq, r.old_bitmap, r.old_vector, r.bitmap, r.vector), *(((r.seq + 1, r.bitmap, r.vector, None, None),) if r.ends else ())):
                both_old = _positions(old)
                both_new = _positions(new)
                common, i, j = np.intersect1d(both_old, both_new, assume_unique=True, return_indices=True)
                a = np.frombuffer(ov or b"", f"V{DIGEST}")[i]
                b = np.frombuffer(nv or b"", f"V{DIGEST}")[j]
                for kind, slots in (("added", _and_not(new, old)), ("removed", _and_not(old, new)), ("changed", common[a != b])):
                    if len(slots):
                        out.append(pd.DataFrame({"seq": seq, "bucket": r.bucket, "pos": np.asarray(slots, np.int64) + r.page * PAGE, "change": kind}))
        if out:
            yield pd.concat(out)


def _changes(boxes: DataFrame, dictionary: DataFrame, last: int) -> DataFrame:
    """(seq, key, change) between neighbouring snapshots among the containers; those that end before the last snapshot count as removed."""
    w = Window.partitionBy("bucket", "page").orderBy("seq")
    before = F.lag("seq").over(w) == F.col("seq") - 1
    ends = F.coalesce(F.lead("seq").over(w) != F.col("seq") + 1, F.lit(True)) & (F.col("seq") < last)
    pairs = boxes.select("seq", "bucket", "page", "bitmap", "vector", F.when(before, F.lag("bitmap").over(w)).alias("old_bitmap"), F.when(before, F.lag("vector").over(w)).alias("old_vector"), ends.alias("ends"))
    found = pairs.mapInPandas(_compare, "seq int, bucket int, pos bigint, change string")
    return found.join(dictionary, ["bucket", "pos"]).select("seq", "key", "change")


class SnapshotStore:
    """Ordinals and containers of all snapshots delivered so far, in a folder that executors share.

    Each delivery adds a version to both tables: the keys that are new, with their ordinals, and the containers of its
    snapshots. Nothing stored is ever rewritten, so ordinals persist; a version whose writing broke off is written anew.
    """

    def __init__(self, spark: SparkSession, path: str, per_bucket: int = 8_192):
        self.spark, self.path, self.per_bucket = spark, path.rstrip("/"), per_bucket
        self.version = 0
        while self._done(f"containers/{self.version}"):
            self.version += 1

    def _done(self, name: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}/_SUCCESS")
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def _read(self, table: str) -> DataFrame | None:
        return self.spark.read.parquet(*[f"{self.path}/{table}/{v}" for v in range(self.version)]) if self.version else None

    def advance(self, rows: DataFrame, last: int | None = None) -> DataFrame:
        """(seq, key, change): changes of the snapshots in rows (seq INT, key STRING, digest BINARY of 16 bytes) against the one before each, stored or new.

        seq counts the snapshots 1, 2, ... and goes on where the store ended; a snapshot without rows counts as empty
        (``last`` names it if it is the newest), and nothing is reported for the first. Null keys are left out; of rows
        that share snapshot and key the least digest counts.
        """
        rows = cut(rows.where("key is not null and seq is not null").groupBy("seq", "key").agg(F.min("digest").alias("digest")))
        known, stored = self._read("dictionary"), self._read("containers")
        had = stored.agg(F.max("seq")).first()[0] if stored is not None else None
        last = max(last or 0, rows.agg(F.max("seq")).first()[0] or 0, had or 0)
        fresh = key_dictionary(rows, known, self.per_bucket, only_new=True)
        fresh.write.mode("overwrite").parquet(f"{self.path}/dictionary/{self.version}")
        now = self.spark.read.parquet(f"{self.path}/dictionary/{self.version}")
        dictionary = now if known is None else known.unionByName(now)
        mark = self.spark.createDataFrame([(last, -1, 0, b"a", b"")], _CONTAINER)  # an empty container, so that an empty snapshot is remembered
        containers(rows, dictionary).unionByName(mark).write.mode("overwrite").parquet(f"{self.path}/containers/{self.version}")
        boxes = self.spark.read.parquet(f"{self.path}/containers/{self.version}")
        if had is not None:
            boxes = boxes.unionByName(stored.where(F.col("seq") == had))
        self.version += 1
        return _changes(boxes, dictionary, last).where(F.col("seq") > F.lit(had or 1))


def snapshot_changes(rows: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    """As ``SnapshotStore.advance`` for snapshots that are all given at once, without storing them. Empty input gives an empty result."""
    rows = cut(rows.where("key is not null and seq is not null").groupBy("seq", "key").agg(F.min("digest").alias("digest")))
    dictionary = cut(key_dictionary(rows, dictionary))
    return _changes(containers(rows, dictionary), dictionary, rows.agg(F.max("seq")).first()[0] or 0).where("seq > 1")


def latest_rows(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """The row of each ``by`` with the greatest ``order`` values, by one aggregation without sorting groups."""
    rest = [c for c in df.columns if c not in by]
    return df.groupBy(*by).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*by, "_r.*")


def snapshot_numbers(df: DataFrame, at: str) -> DataFrame:
    """(at, seq): the distinct snapshot times, numbered. One row per snapshot of the table's history."""
    return df.select(at).where(F.col(at).isNotNull()).distinct().withColumn("seq", F.row_number().over(Window.orderBy(at)))


def valid_packs(packs: DataFrame) -> DataFrame:
    """The valid row of a pcode at a pack date: the one loaded last (then the greatest pack_row). Only the ids are compared; the rows stay where they are."""
    keyed = packs.where("pcode is not null and pack_date is not null")
    ids = keyed.groupBy("pack_date", "pcode").agg(F.max(F.struct("loaded_at", "pack_row")).alias("_r")).select(F.col("_r.pack_row").alias("pack_row"))
    return keyed.select("pack_row", "pack_date", "pcode", "amend_date", "articles", "loaded_at").join(ids, "pack_row", "left_semi")
