"""Session helpers: table loading, shared-folder checkpoints, bounded broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_MADE: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. Where it is unset, a local folder in local mode (tests); on a cluster that is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
    own = os.path.join(tempfile.gettempdir(), f"stemforge-{os.getuid()}")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new folder for tables of this run within the shared folder, until ``clean``."""
    _MADE.append(f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return _MADE[-1]


def clean(spark: SparkSession) -> int:
    """Delete the folders that this process made by ``fresh_dir``, once their results are written; how many there were. (Checkpoints go with ``spark.cleaner.referenceTracking.cleanCheckpoints``.)"""
    n = 0
    while _MADE:
        path = spark._jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        n += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    return n


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut lineage with a reliable checkpoint, which survives the loss of executors."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=eager)


def stored(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Cut lineage with a table written to the shared folder: smaller than a checkpoint, and only the columns that are needed are read back."""
    path = fresh_dir(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder of ``fresh_dir`` that is read no more."""
    _MADE.remove(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of each action are deleted at its end, not only when the driver collects its garbage. For actions whose results are stored, as a frame run again would shuffle again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def broadcast_below(df: DataFrame, limit: int = 100_000) -> DataFrame:
    """Broadcast hint only where the rows, counted up to one beyond the limit, are within it; else Catalyst chooses a shuffle join."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df
