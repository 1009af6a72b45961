"""Landing, partitioned tables, snapshots, history scans, JSON, JDBC and retention."""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow.functions.timeparts import month_label, ts_like
from basketflow.sources import files

# A run of a stored table is read once its name is in this folder of the table; the name is written after all its partitions.
RUNS = "_runs"
# One task sorts so many rows, or rows of so many stored bytes, in memory; it has this share of them at least.
TASK_ROWS, TASK_BYTES, LEAST_SHARE = 1_000_000, 32 << 20, 0.1
# A task stores its rows in so many groups of months at most, a file each.
PARTS = 8


def run_id(at: datetime) -> str:
    return at.strftime("%Y%m%d_%H%M%S")


def write_raw(df: DataFrame, path: str, run: str, compression: str = "snappy") -> bool:
    """Raw landing, one partition per run, which a retry replaces; false where the feed was empty."""
    written = Observation("landing")
    rows = df.observe(written, F.count(F.lit(1)).alias("n")).withColumn("run_id", F.lit(run))
    _replacing(rows, compression).partitionBy("run_id").parquet(path)
    return written.get["n"] > 0


def _replacing(df: DataFrame, compression: str) -> DataFrameWriter:
    """A writer that replaces the partitions it has rows for and leaves the others, so that a retry stores nothing twice."""
    return df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", compression)


def _publish(df: DataFrame, path: str, write, runs: Sequence[str] | None) -> None:
    """Withdraws the runs, writes their partitions, then shows them: a reader sees a run whole or not at all.

    While a run is replaced it is not shown; a run that dies stays unseen until it is repeated. Without names the runs are taken from the rows.
    """
    spark = df.sparkSession
    shown = [str(r) for r in runs] if runs is not None else [str(r.run_id) for r in df.select("run_id").distinct().collect()]
    for run in shown:
        files.delete(spark, f"{path}/{RUNS}/{run}")
    write()
    for run in shown:
        files.write_text(spark, f"{path}/{RUNS}/{run}", "")


def write_prices(df: DataFrame, path: str, compression: str = "snappy", runs: Sequence[str] | None = None, dealt: bool = False) -> None:
    """Main table by run and month, files sorted by time, so that a scan skips months and row groups.

    The rebalance splits a large month over many files and packs small ones; rows of `dealt_by_month` are written where they are.
    The runs are shown when all partitions are there.
    """
    rows = df.withColumn("month", month_label(F.col("timestamp")))
    rows = rows if dealt else rows.hint("rebalance", "run_id", "month")
    writer = _replacing(rows.sortWithinPartitions("run_id", "month", "timestamp"), compression).partitionBy("run_id", "month")
    _publish(df, path, lambda: writer.parquet(path), runs)


def month_number(ts: Column) -> Column:
    return F.year(ts) * 12 + F.month(ts)


def month_groups(counted: Sequence[tuple[int, int]], row_bytes: float, cores: int) -> list[tuple[int, int]]:
    """Months by number with their rows, as at most PARTS groups of consecutive months: (first month, tasks that sort the group's rows in memory)."""
    loads = [(month, rows * max(1 / TASK_ROWS, row_bytes / TASK_BYTES)) for month, rows in sorted(counted)]
    total = sum(load for _, load in loads)
    share = min(1.0, max(LEAST_SHARE, total / cores))
    groups: dict[int, tuple[int, float]] = {}
    before = 0.0
    for month, load in loads:
        at = int((before + load / 2) / max(share, total / PARTS))
        first, held = groups.get(at, (month, 0.0))
        groups[at] = (first, held + load)
        before += load
    return [(first, math.ceil(held / share)) for first, held in groups.values()]


def stage_by_month(df: DataFrame, path: str, compression: str, groups: Sequence[tuple[int, int]]) -> DataFrame:
    """Stores df by group of months (`part`) where its rows are, replacing what was there, and reads it back."""
    month, part = month_number(F.col("timestamp")), F.lit(0)
    for i, (first, _) in enumerate(groups):
        part = F.when(month >= first, i).otherwise(part)
    staged = df.withColumn("part", part)
    writer = staged.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", compression)
    writer.partitionBy("part").parquet(path)
    return df.sparkSession.read.schema(staged.schema).parquet(path)


def dealt_by_month(staged: DataFrame, groups: Sequence[tuple[int, int]]) -> DataFrame:
    """The rows stored by `stage_by_month`, dealt to the tasks of their groups; nothing is shuffled."""
    return reduce(DataFrame.union, [staged.where(F.col("part") == i).drop("part").coalesce(tasks) for i, (_, tasks) in enumerate(groups)])


def write_by_category(df: DataFrame, path: str, compression: str = "snappy", runs: Sequence[str] | None = None) -> None:
    """Second layout by category in one job; a large category is split over many files. The runs are shown when all partitions are there.

    Categories are few, so every task writes its rows of each: nothing is shuffled, and there are at most as many files as tasks by categories.
    """
    writer = _replacing(df, compression).partitionBy("category", "run_id")
    _publish(df, path, lambda: writer.parquet(path), runs)


def shown_runs(spark: SparkSession, path: str) -> list[str]:
    """The complete runs of a stored table, oldest first, by their markers: no data folder is listed."""
    return files.names(spark, f"{path}/{RUNS}")


def _rows(spark: SparkSession, path: str, runs: Sequence[str]) -> DataFrame | None:
    found = []
    for run in runs:
        top = f"{path}/run_id={run}"  # or below each category
        found.append(top if files.names(spark, top) else f"{path}/*/run_id={run}")
    try:
        return spark.read.option("basePath", path).option("ignoreCorruptFiles", True).parquet(*found) if found else None
    except AnalysisException:  # a run without rows has no folder
        return None


def read_prices(spark: SparkSession, path: str) -> DataFrame | None:
    """The complete runs of the stored table, unreadable files skipped; None when nothing is stored."""
    return _rows(spark, path, shown_runs(spark, path))


def latest_snapshot(spark: SparkSession, path: str) -> DataFrame | None:
    """Rows of the newest complete run; no other run is listed or read. None when nothing is stored."""
    return _rows(spark, path, shown_runs(spark, path)[-1:])


def comparable(df: DataFrame) -> list:
    """Columns as group keys; a map has no order, so it is compared as sorted JSON."""
    keys = []
    for field in df.schema:
        c = F.col(field.name)
        if isinstance(field.dataType, T.MapType):
            c = F.to_json(F.array_sort(F.map_entries(c))).alias(field.name)
        keys.append(c)
    return keys


def distinct_rows(df: DataFrame) -> DataFrame:
    maps = [f.name for f in df.schema if isinstance(f.dataType, T.MapType)]
    if not maps:
        return df.distinct()
    keyed = df.withColumns({f"_{m}": F.to_json(F.array_sort(F.map_entries(m))) for m in maps})
    return keyed.dropDuplicates([c for c in keyed.columns if c not in maps]).drop(*[f"_{m}" for m in maps])


def history_scan(df: DataFrame, start: datetime, end: datetime, category: str | None = None) -> DataFrame:
    """Distinct rows of all runs with start <= timestamp <= end; months prune the partitions."""
    ts = F.col("timestamp")
    rows = df.where(ts.between(ts_like(df, "timestamp", start), ts_like(df, "timestamp", end)))
    if "month" in df.columns:
        rows = rows.where(F.col("month").between(f"{start:%Y-%m}", f"{end:%Y-%m}"))
    if category is not None:
        rows = rows.where(F.col("category") == category)
    return distinct_rows(rows.drop("run_id", "month"))


def load_prices(spark: SparkSession, path: str, data: DataFrame | None = None, latest_only: bool = False) -> DataFrame:
    """Input of the index: the given frame, else the stored history (or its newest run)."""
    df = data
    if df is None:
        df = latest_snapshot(spark, path) if latest_only else read_prices(spark, path)
    if df is None:
        raise FileNotFoundError(f"no price data found in {path}")
    return df.withColumn("date", F.to_date("timestamp"))


def read_series(spark: SparkSession, path: str, schema: str = "series_id STRING, date DATE, value DOUBLE") -> DataFrame:
    """Series of the forecast: parquet by its ending, else CSV with header."""
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    return spark.read.csv(path, header=True, schema=schema)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def append_jdbc(df: DataFrame, url: str, table: str = "price_data", batch_size: int = 1000, **properties: str) -> None:
    """Appends to a database table in batches, from all partitions at once."""
    flat = df.select(*[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, T.MapType) else f.name for f in df.schema])
    flat.write.jdbc(url, table, mode="append", properties={"batchsize": str(batch_size), **properties})


def retention_report(df: DataFrame, cutoff: date) -> DataFrame:
    """What retention would free and keep: days, rows and runs before the cutoff and from it on."""
    kept = F.col("date") >= F.lit(cutoff)
    return df.groupBy(F.when(kept, "kept").otherwise("expired").alias("status")).agg(
        F.countDistinct("date").alias("days"), F.count(F.lit(1)).alias("records")
    )


def stored_runs(spark: SparkSession, path: str) -> DataFrame:
    """(run_id, files, bytes, last_write) from the listing of the files; none is opened."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return listed.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("last_write")
    )


def retention_files(spark: SparkSession, path: str, first_kept: str) -> DataFrame:
    """What dropping the runs before `first_kept` would free and keep: runs, files and bytes."""
    kept = F.when(F.col("run_id") >= first_kept, "kept").otherwise("expired").alias("status")
    return stored_runs(spark, path).groupBy(kept).agg(
        F.count(F.lit(1)).alias("runs"), F.sum("files").alias("files"), F.sum("bytes").alias("bytes")
    )


def drop_expired_runs(spark: SparkSession, path: str, now: datetime, days: int = 400) -> dict[str, int]:
    """Deletes whole runs last written more than `days` ago, never the newest run.

    Only run folders pass through the driver: one per run, not one per file.
    """
    runs = stored_runs(spark, path).collect()
    newest = max(r.run_id for r in runs) if runs else None
    expired = [r for r in runs if r.run_id != newest and r.last_write < now - timedelta(days=days)]
    for r in expired:
        files.delete(spark, f"{path}/{RUNS}/{r.run_id}")
        files.delete(spark, f"{path}/run_id={r.run_id}")
    return {
        "runs_deleted": len(expired),
        "files_deleted": sum(r.files for r in expired),
        "bytes_freed": sum(r.bytes for r in expired),
        "retention_days": days,
    }
