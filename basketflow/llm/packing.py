"""Documents into sequences of a fixed number of tokens, by exact complements and best fit on length counts."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import documents, free_names, id_text, stash
from .word_bpe import blocks, word_bpe

CAPACITY = 2048
# Pieces of one length and bucket that are numbered in one task, about.
BUCKET_ROWS = 50_000


def pieces(docs: DataFrame, capacity: int = CAPACITY, with_ids: bool = False, end_id: int = 0, tokenizer: str | None = None) -> DataFrame:
    """The tokens of every document and the end id, cut into pieces: doc_id, piece, start, length, ids_crc32, ids (if asked for).

    Only documents longer than the capacity are cut. Null texts are empty: their piece is the end id alone.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def cut(batches):
        bpe = word_bpe(tokenizer)
        for batch in blocks(batches):
            flat, starts = bpe.ids(batch.column("text"))
            rows = []
            for doc, a, b in zip(batch.column("doc_id").to_pylist(), starts[:-1].tolist(), starts[1:].tolist()):
                ids = np.append(flat[a:b], np.uint32(end_id)).astype("<u4")
                for k, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at : at + capacity]
                    rows.append((doc, k, at, len(part), zlib.crc32(part.tobytes()), part.astype(np.int32)))
            kinds = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64()} | ({"ids": pa.list_(pa.int32())} if with_ids else {})
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds.values())], names=[*kinds])

    return id_text(docs).mapInArrow(cut, schema)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths and how often each is used, for so many pieces of each length.

    From the longest length down, a gap beside it is closed exactly by one length, by two or by three that sum up to it, as often as
    all of them are available. Every such step uses a length up or ends the search for this one, so the number of patterns is bounded by the
    capacity, not by the pieces. What is left goes best fit decreasing, also by counts.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    out: list[tuple[tuple[int, ...], int]] = []

    def use(*lengths: int) -> bool:
        times = min(left[x] // lengths.count(x) for x in lengths)
        if times > 0:
            for x in lengths:
                left[x] -= times
            out.append((lengths, int(times)))
        return times > 0

    def pairs(total: int) -> np.ndarray:
        """Larger lengths a of available pairs a + b = total."""
        a = np.arange((total + 1) // 2, total)
        return a[(left[a] > 0) & (left[total - a] > 0) & ((2 * a != total) | (left[a] > 1))]

    for first in range(capacity, 0, -1):
        gap = capacity - first
        if gap == 0:
            use(first)
        while left[first] and gap:
            if left[gap] and use(first, gap):
                continue
            if any(use(first, int(a), gap - int(a)) for a in pairs(gap)[::-1]):
                continue
            found = False
            for a in np.flatnonzero(left[1 : max(gap - 1, 1)])[::-1] + 1:  # a third length beside a pair
                rest = gap - int(a)
                # Of these pairs only those with a length that is used up by `first` or `a` can fail: at most two, so eight are enough.
                found = any(use(first, int(a), int(b), rest - int(b)) for b in pairs(rest)[::-1][:8])
                if found:
                    break
            if not found:
                break

    # Best fit: sequences with one and the same gap are kept together as patterns with counts.
    open_by_gap: dict[int, list[list]] = defaultdict(list)
    gaps = np.zeros(capacity + 1, np.int64)  # open sequences by gap
    for length in range(capacity, 0, -1):
        while left[length]:
            fit = np.flatnonzero(gaps[length:])
            if len(fit):
                gap = length + int(fit[0])
                pattern, times = open_by_gap[gap].pop()
                taken = min(times, int(left[length]))
                if taken < times:
                    open_by_gap[gap].append([pattern, times - taken])
                gaps[gap] -= taken
            else:
                gap, pattern, taken = capacity, (), int(left[length])
                each = capacity // length
                if taken >= each > 1:  # they would fill one another's gaps
                    taken //= each
                    pattern, gap = (length,) * (each - 1), capacity - length * (each - 1)
                    left[length] -= taken * (each - 1)
                elif each > 1:
                    taken = 1
            left[length] -= taken
            open_by_gap[gap - length].append([(*pattern, length), taken])
            gaps[gap - length] += taken
    out += [(tuple(p), n) for held in open_by_gap.values() for p, n in held]
    return out


def pack(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """rows with `length` (1 to capacity) and the columns doc_id and piece, plus sequence_id and offset.

    The driver sees the counts per length only. Pieces of one length are numbered without gaps (bucket by bucket of a stored random number, so that
    a frequent length or a frequent doc_id is spread), and the number says which use of which pattern a piece is for.
    """
    spark, columns = rows.sparkSession, rows.columns
    (spread,) = free_names(rows, "spread")
    rows = stash(rows.withColumn(spread, F.rand(0)), "pieces")
    counts = {int(r[0]): int(r[1]) for r in rows.groupBy("length").agg(F.count(F.lit(1))).collect()}  # at most `capacity` rows
    places, next_rank, sequence = [], defaultdict(int), 0
    for lengths, times in plan(counts, capacity):
        offset = 0
        for length in lengths:
            places.append((length, next_rank[length], next_rank[length] + times, sequence, offset))
            next_rank[length] += times
            offset += length
        sequence += times
    table = spark.createDataFrame(places, "p_length long, rank_from long, rank_to long, first_sequence long, offset long")
    buckets = max(16, sum(counts.values()) // BUCKET_ROWS)
    bucketed = rows.withColumn("_bucket", F.floor(F.col(spread) * buckets))
    sizes = bucketed.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.partitionBy("length").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1))
    starts = sizes.select("length", "_bucket", F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.row_number().over(W.partitionBy("length", "_bucket").orderBy(spread))
    ranked = bucketed.withColumn("_place", place).join(starts, ["length", "_bucket"]).withColumn("_rank", F.col("_before") + F.col("_place") - 1)
    found = (F.col("length") == F.col("p_length")) & (F.col("_rank") >= F.col("rank_from")) & (F.col("_rank") < F.col("rank_to"))
    placed = ranked.join(F.broadcast(table), found)
    return placed.select(*columns, (F.col("first_sequence") + F.col("_rank") - F.col("rank_from")).alias("sequence_id"), "offset")


def best_fit_packing(docs: DataFrame, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Every piece of every document and its place: doc_id, piece, start, length, ids_crc32, (ids,) sequence_id, offset.

    Null and empty texts are one piece with the end id. Repeated rows and null doc_ids are packed like others. Texts of
    any length are cut whole. No rows give no rows. Other columns are ignored.
    """
    return pack(pieces(docs, capacity, with_ids), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """From pieces packed with ids: sequence_id, ids (at most the capacity), in order of the offsets."""
    held = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return held.select("sequence_id", F.flatten("parts.ids").alias("ids"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(documents(spark, sf_dir))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: the pieces and their places, as best_fit_packing gives them for nulls, empties, repeated rows, ties and no rows."""
    return best_fit_packing(docs)
