"""Session settings and the shared work folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Up to this many rows a side is broadcast; checked by counting, never assumed.
BROADCAST_ROWS = 100_000

# For jobs that store whole rows: shuffle files go when the write they served has ended, a task reads no more than it can sort in memory, and
# frames put together keep their tasks.
LITTLE_DISK = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    "spark.sql.unionOutputPartitioning": "false",
}
# For writes by a column of few values: a file of each stays open, so that rows are not sorted.
SIDE_BY_SIDE = {"spark.sql.maxConcurrentOutputFileWriters": "16"}


def build_session(app: str = "basketflow", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the jobs rely on: UTC and adaptive execution."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the jobs inside; what was set before comes back."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@lru_cache(maxsize=1)
def _local_root() -> str:
    root = tempfile.mkdtemp(prefix="basketflow-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a private one only for a local session without it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    return _local_root()


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared root."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to a work folder and read back: what follows neither repeats it nor depends on the executors that made it."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame) -> tuple[DataFrame, int]:
    """Persist an aggregated side and count it. Lost blocks are recomputed from the lineage."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    return kept, kept.count()


def join_checked(fact: DataFrame, side: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join the fact rows with a grouped side, by broadcast only when its counted rows are few.

    Beyond the bound the join is shuffled and adaptive execution splits the skewed partitions.
    """
    kept, rows = materialize(side)
    return fact.join(F.broadcast(kept) if rows <= BROADCAST_ROWS else kept, keys, how)
