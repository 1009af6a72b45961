"""The daily run: land every feed with its quarantine, transform, check, load, and log it as one row."""

from __future__ import annotations

import time
from dataclasses import replace
from datetime import datetime
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow.config import EtlConfig, QualityConfig
from basketflow.functions.text import normalize_category
from basketflow.operators.outliers import category_stats, drop_outliers, flag_outliers
from basketflow.operators.quality import quality_gate, quality_report, quality_summary
from basketflow.operators.transform import transform
from basketflow.schema import PRICE_SCHEMA
from basketflow.session import LITTLE_DISK, SIDE_BY_SIDE, materialize, settings
from basketflow.sources import files, storage
from basketflow.sources.ingest import conform, incremental, judged, select_sources

RUN_LOG = (
    "run_id STRING, landed BIGINT, quarantined BIGINT, transformed BIGINT, outliers BIGINT, stored BIGINT, stored_share DOUBLE, "
    "seconds DOUBLE, problems ARRAY<STRING>"
)
LANDED = T.StructType(
    [*PRICE_SCHEMA.fields, T.StructField("reasons", T.ArrayType(T.StringType())), T.StructField("feed", T.StringType()), T.StructField("valid", T.BooleanType())]
)


def feed_folder(root: str, name: str) -> str:
    return f"{root}/feed={quote(name, safe='')}"


def landed(spark: SparkSession, root: str, feeds: list[str] | None = None) -> DataFrame:
    """What a run landed, sound rows (`valid`) and quarantined ones with their `reasons`; of some feeds if named."""
    paths = [root] if feeds is None else [feed_folder(root, name) for name in feeds]
    return spark.read.schema(LANDED).option("basePath", root).parquet(*paths)


def land(spark: SparkSession, feeds: dict[str, DataFrame], cfg: EtlConfig, root: str, now: datetime) -> tuple[list[str], int, int, list[str]]:
    """Writes every feed in one pass into a folder of its own, which a retry replaces.

    Returns the feeds that landed, their sound and quarantined rows, and the problems: a feed that can't be
    planned, read or written is noted, and the others go on.
    """
    done, sound, broken, problems = [], 0, 0, []
    for name, feed in feeds.items():
        seen = Observation("landing")
        try:
            wanted = select_sources(conform(feed, now), list(cfg.retailers), list(cfg.categories or []))
            rows = judged(wanted.withColumn("category", normalize_category(F.col("retailer"), F.col("category"))))
            counted = rows.observe(seen, F.count_if("valid").alias("sound"), F.count_if(~F.col("valid")).alias("broken"))
            folder = feed_folder(root, name)
            with settings(spark, LITTLE_DISK | SIDE_BY_SIDE):
                counted.write.mode("overwrite").option("compression", cfg.compression).partitionBy("valid").parquet(folder)
        except (PySparkException, Py4JJavaError) as e:
            problems.append(f"feed {name}: {str(e).strip().splitlines()[0]}")
            continue
        done.append(name)
        sound, broken = sound + seen.get["sound"], broken + seen.get["broken"]
    return done, sound, broken, problems


def run(spark: SparkSession, feeds: dict[str, DataFrame], cfg: EtlConfig, now: datetime, quality: QualityConfig | None = None) -> DataFrame:
    """One run over the feeds; its log is one row, see RUN_LOG. Counts come with the writes, without passes of their own.

    A failure is logged among the problems instead of raised, except for invalid data under the policy 'raise'. Repeating a run replaces what it stored.
    """
    began = time.monotonic()
    log = {"landed": 0, "quarantined": 0, "transformed": 0, "outliers": 0, "stored": 0}
    problems: list[str] = []
    try:
        with settings(spark, LITTLE_DISK):
            _stages(spark, feeds, cfg, now, quality, log, problems)
    except (PySparkException, Py4JJavaError) as e:
        problems.append(f"run stopped: {str(e).strip().splitlines()[0]}")
    share = log["stored"] / log["landed"] if log["landed"] else 0.0
    row = (storage.run_id(now), *log.values(), share, time.monotonic() - began, problems)
    return spark.createDataFrame([row], RUN_LOG)


def _stages(spark, feeds, cfg, now, quality, log, problems) -> None:
    run_id = storage.run_id(now)
    root = f"{cfg.raw_path}/run_id={run_id}"
    done, log["landed"], log["quarantined"], troubles = land(spark, feeds, cfg, root, now)
    problems += troubles
    if not log["landed"]:
        return

    # Stored, not cached: the checks and both loads read it, and a lost executor costs no rerun. By month, so that the load by month shuffles nothing.
    stage, transformed, loaded = f"{cfg.output_path}/transformed/run_id={run_id}", Observation("transformed"), Observation("loaded")
    n = F.count(F.lit(1)).alias("n")
    sound = landed(spark, root, done).where("valid").drop("reasons", "feed", "valid")
    counted = [(r.month, r.n) for r in sound.groupBy(storage.month_number(F.col("timestamp")).alias("month")).agg(n).collect()]
    stored_bytes = sum(files.size(spark, f"{feed_folder(root, name)}/valid=true") for name in done)
    groups = storage.month_groups(counted, stored_bytes / log["landed"], spark.sparkContext.defaultParallelism)
    staged = storage.stage_by_month(transform(sound, rows=log["landed"]).observe(transformed, n), stage, cfg.compression, groups)
    log["transformed"] = transformed.get["n"]
    panel, stats = staged.drop("part"), None

    if cfg.validate:
        stats, _ = materialize(category_stats(panel))  # one row per category, for the report and the cleaning
        checked = quality_gate(quality_summary(quality_report(panel, now, quality, stats)), cfg.on_invalid)
        problems += checked.errors
        log["outliers"] = checked.outlier_count or 0

    def cleaned(rows: DataFrame) -> DataFrame:
        kept = rows if stats is None else drop_outliers(flag_outliers(rows, quality, stats))
        return kept.withColumn("run_id", F.lit(run_id))

    dealt = cleaned(storage.dealt_by_month(staged, groups))
    storage.write_prices(dealt.observe(loaded, n), f"{cfg.output_path}/prices", cfg.compression, [run_id], dealt=True)
    log["stored"] = loaded.get["n"]
    clean = cleaned(panel)
    large = {"spark.sql.files.maxPartitionBytes": "128m", "spark.sql.files.openCostInBytes": "256k"}  # nothing is sorted, so few tasks and files
    with settings(spark, SIDE_BY_SIDE | large):
        storage.write_by_category(clean, f"{cfg.output_path}/by_category", cfg.compression, [run_id])
    if cfg.jdbc_url:
        try:
            storage.append_jdbc(clean, cfg.jdbc_url, batch_size=cfg.jdbc_batch_size)
        except (PySparkException, Py4JJavaError) as e:  # the load goes on without the database
            problems.append(f"database: {str(e).strip().splitlines()[0]}")


def run_incremental(
    spark: SparkSession,
    feeds: dict[str, DataFrame],
    cfg: EtlConfig,
    now: datetime,
    since: datetime | None = None,
    categories: tuple[str, ...] | None = None,
) -> DataFrame:
    """A run over rows newer than `since`, for some categories if named."""
    newer = {name: incremental(feed, since) for name, feed in feeds.items()}
    return run(spark, newer, replace(cfg, categories=categories or cfg.categories), now)
