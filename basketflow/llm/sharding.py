"""Shards of near equal bytes: minimax contiguous partition of ordered atomic groups."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import documents, id_text, stash

SHARDS = 16
# Hex digits of the group key that the first look at the sizes goes by, and by which each later look goes deeper.
FIRST, DEEPER = 3, 2
BUCKET_ROWS = 50_000


class Segments:
    """Ordered stretches of groups: key prefix, bytes, number of groups, bytes of the largest group."""

    def __init__(self, rows: list[tuple[str, int, int, int]]):
        self.rows = sorted(rows)
        self.ends = np.cumsum([0] + [r[1] for r in self.rows])
        self.whole = np.array([r[2] == 1 for r in self.rows])
        self.largest = max((r[3] for r in self.rows), default=0)

    def cuts(self, capacity: int, shards: int, divide: bool) -> list[int]:
        """Greedy: for each shard but the last the first segment that it doesn't hold in full.

        Without divide every segment is taken for atomic, which no finer cutting can do worse than; with it only single groups are, which no cutting can
        do better than.
        """
        out, start = [], 0
        for _ in range(shards - 1):
            end = start + capacity
            at = int(np.searchsorted(self.ends, end, "right")) - 1
            out.append(at)
            if at >= len(self.rows):
                start = int(self.ends[-1])
            else:
                start = end if divide and not self.whole[at] else int(self.ends[at])
        return out

    def feasible(self, capacity: int, shards: int, divide: bool) -> bool:
        if capacity < self.largest:
            return False
        start = 0
        for _ in range(shards):
            end = start + capacity
            at = int(np.searchsorted(self.ends, end, "right")) - 1
            if at >= len(self.rows):
                return True
            start = end if divide and not self.whole[at] else int(self.ends[at])
        return False

    def least(self, shards: int, divide: bool) -> int:
        """Smallest feasible capacity, by binary search."""
        low, high = 0, int(self.ends[-1])
        while low < high:
            mid = (low + high) // 2
            low, high = (low, mid) if self.feasible(mid, shards, divide) else (mid + 1, high)
        return low


def minimax_cuts(look: Callable[[list[str] | None, int], list[tuple[str, int, int, int]]], shards: int) -> tuple[list[str], int]:
    """(first key prefix of each shard but the first, smallest capacity) for groups that `look` shows in stretches.

    look(prefixes, width): sizes of the groups under these prefixes (None: all), by prefixes of this width. Only stretches in which a cut may fall are looked into.
    """
    width = FIRST
    rows = look(None, width)
    while True:
        segments = Segments(rows)
        low, high = segments.least(shards, True), segments.least(shards, False)
        unsure = set()
        for a, b in zip(segments.cuts(low, shards, False), segments.cuts(high, shards, True)):
            unsure.update(range(a, min(b + 1, len(rows))))
        deeper = [segments.rows[i][0] for i in sorted(unsure) if not segments.whole[i] and len(segments.rows[i][0]) == width]
        if not deeper:
            found = segments.cuts(high, shards, False)
            return [segments.rows[i][0] if i < len(rows) else "g" for i in found], high  # "g" is after every hex digit
        below = set(deeper)
        width += DEEPER
        rows = [r for r in segments.rows if r[0] not in below] + look(deeper, width)


def balanced_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Every row of docs: doc_id, size, text_crc32, law, shard, slot, grown_shard, digest.

    Rows of equal text are one atomic group; groups are ordered by their digest and cut into contiguous shards so that the largest
    shard is as small as it can be. Size is the text's bytes in UTF-8 and one more; null texts go with empty ones. slot numbers the rows of a shard
    from 0 without gaps, in no stated order. Repeated rows and null doc_ids are rows like others. With fewer groups than shards some shards stay empty. No rows give no rows.
    Other columns are ignored.

    The driver sees sums over key prefixes: 4,096 at first, then 256 for each stretch where a cut may fall. Rows are numbered in buckets of a
    stored random number, so rows of one doc_id, or without any, don't share a bucket.
    """
    text = F.encode("text", "UTF-8")
    rows = stash(id_text(docs).select("doc_id", (F.octet_length("text") + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.sha2(text, 256).alias("digest"), F.rand(0).alias("spread")), "sizes")
    groups = stash(rows.groupBy("digest").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")), "groups")

    def look(prefixes, width):
        held = groups if prefixes is None else groups.filter(F.substring("digest", 1, len(prefixes[0])).isin(prefixes))
        return [tuple(r) for r in held.groupBy(F.substring("digest", 1, width)).agg(F.sum("bytes"), F.count(F.lit(1)), F.max("bytes")).collect()]

    firsts, _ = minimax_cuts(look, shards)
    shard = sum((F.when(F.col("digest") >= key, 1).otherwise(0) for key in firsts), F.lit(0))
    total = groups.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    buckets = max(16, total // (shards * BUCKET_ROWS))
    placed = rows.withColumn("shard", shard.cast("int")).withColumn("_bucket", F.floor(F.col("spread") * buckets))
    sizes = placed.groupBy("shard", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.partitionBy("shard").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1))
    starts = sizes.select("shard", "_bucket", F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.row_number().over(W.partitionBy("shard", "_bucket").orderBy("spread"))
    return placed.withColumn("_place", place).join(starts, ["shard", "_bucket"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("_before") + F.col("_place") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "digest"
    )


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balanced_shards(documents(spark, sf_dir)).drop("digest")
