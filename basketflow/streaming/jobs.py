"""Hourly keep-last and sliding category index over a stream of price observations.

A job reduces every micro-batch on its own and writes the partial result to the batch's folder, replaced
when the batch is replayed. Partials merge by the same reduction in any order, so rows may come
however late: nothing waits for a watermark and nothing is dropped. Partials are folded level by level as batches come.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow.operators.price_index import category_index
from basketflow.session import BROADCAST_ROWS, materialize
from basketflow.sources import files

HOUR_KEY = ["product_id", "retailer", "hour_start"]
Sink = Callable[[DataFrame, int], None]
Reduction = Callable[[DataFrame], DataFrame]
# Folders of one level that are folded into one of the next, and where the lists of the folders in use are.
FAN = 4
LISTS = "_live"


def read_stream(spark: SparkSession, folder: str, pattern: str, schema: T.StructType, files_per_batch: int = 1000) -> DataFrame:
    """Parquet files of a folder as a stream."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def _live(spark: SparkSession, path: str) -> list[tuple[int, int, str]]:
    """(last batch, level, folder) of the partial results that make up the state, by the newest list of them."""
    lists = files.names(spark, f"{path}/{LISTS}")
    return [(e[0], e[1], e[2]) for e in json.loads(files.read_text(spark, f"{path}/{LISTS}/{lists[-1]}"))] if lists else []


def _list(spark: SparkSession, path: str, live: list[tuple[int, int, str]], passing: Sequence[str] = ()) -> None:
    """Makes these folders the state, then removes what the list before the last one had and no later one has, and folders on the way that no list had."""
    lists = files.names(spark, f"{path}/{LISTS}")
    old = {f for name in lists[:-1] for *_, f in json.loads(files.read_text(spark, f"{path}/{LISTS}/{name}"))}
    kept = {f for *_, f in live} | {f for *_, f in _live(spark, path)}
    files.write_text(spark, f"{path}/{LISTS}/{len(lists) and int(lists[-1]) + 1:012d}", json.dumps(live))
    for name in lists[:-1]:
        files.delete(spark, f"{path}/{LISTS}/{name}")
    for folder in sorted((old | set(passing)) - kept):
        files.delete(spark, f"{path}/{folder}")


def _read(spark: SparkSession, path: str, schema: T.StructType, live: list[tuple[int, int, str]]) -> DataFrame:
    if not live:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{folder}" for *_, folder in live])


def batch_folder_sink(reduce: Reduction, path: str, also: Sink | None = None, merge: Reduction | None = None) -> Sink:
    """The reduced micro-batch in a folder of its own; the same batch written twice replaces itself.

    With `merge`, the last FAN folders of one level are folded into one of the next level, again and again. So the state after n batches lies in fewer
    than FAN folders for each of log(n) levels, and a batch is written anew no more often than there are levels. A list
    of the folders in use, written last, makes the change; what is in no list is not read.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        live = _live(spark, path)
        reduced = reduce(batch)
        if not live or batch_id > live[-1][0]:
            live, made = [*live, (batch_id, 0, f"batches/batch_id={batch_id}")], [f"batches/batch_id={batch_id}"]
            reduced.write.mode("overwrite").parquet(f"{path}/{live[-1][2]}")
            while merge is not None and len(live) >= FAN and len({level for _, level, _ in live[-FAN:]}) == 1:
                last, level, _ = live[-1]
                folder = f"folded/level={level + 1}/until={last}"
                merge(_read(spark, path, reduced.schema, live[-FAN:])).write.mode("overwrite").parquet(f"{path}/{folder}")
                live = [*live[:-FAN], (last, level + 1, folder)]
                made.append(folder)
            _list(spark, path, live, made)
        if also is not None:
            also(reduced, batch_id)

    return write


def run_available(
    stream: DataFrame, reduce: Reduction, path: str, checkpoint: str, also: Sink | None = None, merge: Reduction | None = None
) -> T.StructType:
    """Works off everything there is, then stops; the checkpoint carries on from there next time. The schema of the partials."""
    query = (
        stream.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(batch_folder_sink(reduce, path, also, merge))
        .start()
    )
    query.awaitTermination()
    return reduce(stream.sparkSession.createDataFrame([], stream.schema)).schema


def merged(spark: SparkSession, path: str, schema: T.StructType, merge: Reduction) -> DataFrame:
    """The state after all batches so far; empty before the first batch. Only the folders in use are looked at."""
    return merge(_read(spark, path, schema, _live(spark, path)))


def compact(spark: SparkSession, path: str, schema: T.StructType, merge: Reduction) -> None:
    """Folds all batches so far into one folder, above all levels there are."""
    live = _live(spark, path)
    if len(live) > 1:
        last, level = live[-1][0], max(level for _, level, _ in live) + 1
        folder = f"folded/level={level}/until={last}"
        merge(_read(spark, path, schema, live)).write.mode("overwrite").parquet(f"{path}/{folder}")
        _list(spark, path, [(last, level, folder)])


def hourly_last(order: list[str]) -> Reduction:
    """Last observation per product, retailer and hour; `order` breaks ties of the timestamp."""

    def reduce(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("hour_start", F.date_trunc("hour", F.col("timestamp").cast("timestamp")))
        payload = [c for c in rows.columns if c not in HOUR_KEY]
        last = F.max_by(F.struct(*payload), F.struct("timestamp", *order)).alias("row")
        return rows.groupBy(*HOUR_KEY).agg(last).select(*HOUR_KEY, "row.*")

    return reduce


def daily_relatives(base: DataFrame) -> Reduction:
    """(day, category) -> matched rows and sum of log price relatives, of a batch.

    Rows shrink to one per day and product before the base prices are joined, so no product is hot in that join.
    """
    side, rows = materialize(base.where("base_price > 0").select("category", "product_id", F.ln("base_price").alias("ln_base")))

    def reduce(batch: DataFrame) -> DataFrame:
        daily = (
            batch.where("price > 0 AND NOT isnan(price)")
            .groupBy(F.to_date("timestamp").alias("day"), "category", "product_id")
            .agg(F.count(F.lit(1)).alias("n"), F.sum(F.ln("price")).alias("ln_price"))
        )
        joined = daily.join(F.broadcast(side) if rows <= BROADCAST_ROWS else side, ["category", "product_id"])
        return daily_sums(joined.select("day", "category", F.col("n").alias("n_rel"), (F.col("ln_price") - F.col("n") * F.col("ln_base")).alias("ln_sum")))

    return reduce


def daily_sums(partials: DataFrame) -> DataFrame:
    """One row per day and category from any number of partial ones."""
    return partials.groupBy("day", "category").agg(F.sum("n_rel").alias("n_rel"), F.sum("ln_sum").alias("ln_sum"))


def sliding_index(daily: DataFrame, days: int = 7, min_observations: int = 10) -> DataFrame:
    """(window_start, window_end, category): index of each window of `days` days, stepping one day.

    Windows are half-open: the end belongs to the next window.
    """
    starts = F.sequence(F.date_sub("day", days - 1), F.col("day"))
    sums = (
        daily.withColumn("window_start", F.explode(starts))
        .groupBy("window_start", "category")
        .agg(F.sum("n_rel").alias("n_rel"), F.sum("ln_sum").alias("ln_sum"))
    )
    return sums.select(
        "window_start",
        F.date_add("window_start", days).alias("window_end"),
        "category",
        "n_rel",
        category_index(F.col("n_rel"), F.col("ln_sum"), min_observations).alias("price_index"),
    )

