"""Importance resampling towards a target set: hashed features, log ratios of bucket counts, a global Gumbel draw.

Buckets come from CRC-32 of feature spans. The checksum is linear over XOR, so each byte of a span contributes a word that depends only on
the byte and its distance from the end of its span. These words lie in a table; one bitwise_xor.reduceat joins those of all spans of a
block, and a constant per length accounts for the initial register. Spans longer than the table fold block after block.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import documents, id_text, stash
from .word_bpe import blocks

BUCKETS = 10_000
RUNS = (1, 1)
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
BLOCK_BYTES = 4_000_000
_POLYNOMIAL = 0xEDB88320
_FULL = np.uint32(0xFFFFFFFF)


class SpanCrc:
    """CRC-32 (as zlib's) of many spans of a byte array at once."""

    def __init__(self, reach: int = 64):
        if reach < 4:
            raise ValueError("reach must be at least 4")
        self.reach = reach
        one = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            one = np.where(one & np.uint32(1), one >> np.uint32(1) ^ np.uint32(_POLYNOMIAL), one >> np.uint32(1))
        table = [one]
        for _ in range(reach - 1):
            table.append(one[table[-1] & np.uint32(255)] ^ table[-1] >> np.uint32(8))
        self.table = np.concatenate(table)  # [distance from the end * 256 + byte]
        initial = [_FULL]
        for _ in range(reach):
            initial.append(one[initial[-1] & np.uint32(255)] ^ initial[-1] >> np.uint32(8))
        self.initial = np.array(initial, np.uint32)

    def _moved(self, register: np.ndarray) -> np.ndarray:
        """Registers after `reach` zero bytes: their four bytes count like the first four of a span."""
        out = np.zeros(len(register), np.uint32)
        for i in range(4):
            byte = register >> np.uint32(8 * i) & np.uint32(255)
            out ^= self.table[(self.reach - 1 - i) * 256 + byte.astype(np.int64)]
        return out

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.zeros(len(starts), np.uint32)
        some = np.flatnonzero(ends > starts)
        if not len(some):
            return out
        starts, lengths = starts[some], (ends - starts)[some]
        # All pieces of a span but its first are `reach` long.
        pieces = -(-lengths // self.reach)
        first = lengths - (pieces - 1) * self.reach
        at = np.cumsum(pieces) - pieces
        size = np.full(int(pieces.sum()), self.reach, np.int64)
        size[at] = first
        begin = np.repeat(starts + first - self.reach, pieces) + (np.arange(len(size)) - np.repeat(at, pieces)) * self.reach
        begin[at] = starts
        stop = np.cumsum(size)
        place = np.arange(stop[-1], dtype=np.int32)
        distance = np.repeat(stop.astype(np.int32), size)
        distance -= place
        distance -= 1
        place += np.repeat((begin - (stop - size)).astype(np.int32), size)
        distance <<= 8
        distance += data[place]
        part = np.bitwise_xor.reduceat(self.table[distance], stop - size)
        register = self.initial[first] ^ part[at]
        folded, left = 1, np.flatnonzero(pieces > 1)
        while len(left):
            register[left] = self._moved(register[left]) ^ part[at[left] + folded]
            folded += 1
            left = left[pieces[left] > folded]
        out[some] = register ^ _FULL
        return out


_CRC = SpanCrc()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True


def word_spans(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes of all texts; start, end and text number of every word: runs of digits, a-z and bytes from 128 on."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    size = offsets[-1] - offsets[0]
    if not size:
        return np.empty(0, np.uint8), *(np.empty(0, np.int64) for _ in range(3))
    data = _LOWER[np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]]
    offsets = offsets - offsets[0]
    inside = _IN_WORD[data]
    border = np.zeros(size + 1, bool)
    border[offsets] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | border[1:-1]
    ends[:-1] &= ~inside[1:] | border[1:-1]
    starts = np.flatnonzero(begins)
    return data, starts, np.flatnonzero(ends) + 1, np.searchsorted(offsets, starts, "right") - 1


def features(texts: pa.Array, buckets: int = BUCKETS, runs: tuple[int, int] = RUNS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and text number of every feature (run of so many words, joined by one space); number of words of every text."""
    data, starts, ends, owner = word_spans(texts)
    counts = np.bincount(owner, minlength=len(texts))
    if runs[1] > 1 and len(starts):  # words one after another, a space behind each
        lengths = ends - starts + 1
        stop = np.cumsum(lengths)
        place = np.arange(stop[-1]) + np.repeat(starts - (stop - lengths), lengths)
        data = data[np.minimum(place, len(data) - 1)]
        data[stop - 1] = 32
        starts, ends = stop - lengths, stop - 1
    found, owners = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for n in range(runs[0], runs[1] + 1):
        if len(starts) < n:
            break
        whole = np.flatnonzero(owner[: len(owner) - n + 1] == owner[n - 1 :])
        found.append((_CRC(data, starts[whole], ends[whole + n - 1]) % np.uint32(buckets)).astype(np.int64))
        owners.append(owner[whole])
    return np.concatenate(found), np.concatenate(owners), counts


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, runs: tuple[int, int] = RUNS) -> np.ndarray:
    """Features per bucket over all rows with a text. A task sends one row per bucket, the driver gets no more rows than buckets."""

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for block in blocks([batch], limit=BLOCK_BYTES):
                total += np.bincount(features(block.column("text"), buckets, runs)[0], minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], names=["bucket", "n"])

    rows = texts.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(count, "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for row in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def gains(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the ratio of the smoothed shares) of every bucket."""
    whole_target, whole_raw = float(target.sum() + len(target)), float(raw.sum() + len(raw))
    return np.array([math.floor(1000 * math.log((t + 1) * whole_raw / ((s + 1) * whole_target))) for t, s in zip(target.tolist(), raw.tolist())], np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, runs: tuple[int, int] = RUNS) -> DataFrame:
    """doc_id, n_words, n_features, weight of every row."""

    def weigh(batches):
        for batch in batches:
            for block in blocks([batch], limit=BLOCK_BYTES):
                found, owner, words = features(block.column("text"), len(gain), runs)
                sums = np.zeros(block.num_rows, np.int64)
                np.add.at(sums, owner, gain[found])
                columns = [words, np.bincount(owner, minlength=block.num_rows), sums]
                yield pa.RecordBatch.from_arrays([block.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns)], names=["doc_id", "n_words", "n_features", "weight"])

    return id_text(docs).mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def drawn(rows: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """rows (doc_id, n_words, n_features, weight) with score and rank of the drawn ones.

    The rows are sorted over all tasks, a stored number orders them within a task, and the counts of the tasks before are added: no
    window holds more than one row per task. Rows that tie in score and doc_id are parted by a random number, so they need not share a task.
    """
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(name, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = stash(rows.select("*", (F.col("weight") + noise).alias("score"), F.rand(seed).alias("tie")), "importance")
    order = [F.col("n_words") >= min_words, F.col("score"), F.col("doc_id"), F.col("tie")]
    sorted_rows = scored.orderBy(order[0].desc(), order[1].desc(), order[2].asc_nulls_last(), order[3]).withColumn("place", F.monotonically_increasing_id())
    placed = stash(sorted_rows.drop("tie"), "importance-order").withColumns({"task": F.shiftright("place", 33), "place": F.col("place").bitwiseAND(2**33 - 1)})
    before = W.orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    tasks = placed.groupBy("task").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(order[0], 1)).alias("able"))
    tasks = tasks.select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), F.sum("able").over(W.partitionBy()).alias("able"))
    rank = F.col("before") + F.col("place") + 1
    rank = F.when(order[0] & (rank <= F.floor(F.col("able") * percent / 100)), rank)
    return placed.join(F.broadcast(tasks), "task").select("doc_id", "n_words", "n_features", "weight", "score", rank.cast("long").alias("rank"))


def target_sample(
    docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, runs: tuple[int, int] = RUNS, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED
) -> DataFrame:
    """Every row of docs: doc_id, n_words, n_features, weight, score, rank; rank numbers the drawn percentage of rows with enough words.

    Counts cover all texts of docs and of target; buckets are a parameter of the hashed model, so the two count tables have that many rows
    at any size. Null and empty texts have no features and weight 0; a null doc_id takes part with an empty name and ranks behind others of
    its score. Repeated rows all count and rank one after another. Very long texts and words count whole. Empty tables
    give no rows, an empty target a model of equal shares. Other columns of docs and target are ignored.
    """
    gain = gains(bucket_counts(target, buckets, runs), bucket_counts(docs, buckets, runs))
    return drawn(weighted(docs, gain, runs), percent, min_words, seed)


def op13_target_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = target_sample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


# CRC-32 four bits at a time, over the distinct words only; the table of 16 follows from the polynomial.
OP13_SQL = r"""
WITH RECURSIVE steps AS (
  SELECT i::BIGINT AS i, i::BIGINT AS v, 0 AS step FROM range(16) t(i)
  UNION ALL
  SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, step + 1 FROM steps WHERE step < 4
),
tab AS (SELECT list(v ORDER BY i) AS t FROM steps WHERE step = 4),
doc_words AS (
  SELECT rid, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
  FROM (SELECT row_number() OVER () AS rid, text FROM documents)
),
bench_words AS (
  SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
  FROM benchmark
),
nibbles AS (
  SELECT w, list_transform(range(1, length(hex(w)) + 1), lambda i: instr('0123456789ABCDEF', substr(hex(w), CASE WHEN i % 2 = 1 THEN i + 1 ELSE i - 1 END, 1)) - 1) AS s
  FROM (SELECT w FROM doc_words UNION SELECT w FROM bench_words)
),
hashed AS (
  SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT, s::BIGINT[]), lambda a, b: xor(a >> 4, t[(xor(a, b) & 15) + 1])), 4294967295) % 10000 AS bucket
  FROM nibbles, tab
),
raw AS (SELECT bucket, count(*) AS n FROM doc_words JOIN hashed USING (w) GROUP BY bucket),
target AS (SELECT bucket, count(*) AS n FROM bench_words JOIN hashed USING (w) GROUP BY bucket),
gain AS (
  SELECT bucket, floor(1000 * ln((coalesce(target.n, 0) + 1)::DOUBLE * (coalesce((SELECT sum(n) FROM raw), 0) + 10000)::DOUBLE
    / ((coalesce(raw.n, 0) + 1)::DOUBLE * (coalesce((SELECT sum(n) FROM target), 0) + 10000)::DOUBLE)))::BIGINT AS g
  FROM raw FULL JOIN target USING (bucket)
),
weights AS (SELECT rid, count(*) AS n, sum(g)::BIGINT AS weight FROM doc_words JOIN hashed USING (w) JOIN gain USING (bucket) GROUP BY rid),
scored AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM (SELECT row_number() OVER () AS rid, doc_id FROM documents) LEFT JOIN weights USING (rid)
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS r, count(*) FILTER (n_features >= 20) OVER () AS able FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND r <= able * 10 // 100 THEN r END AS rank FROM ranked
"""
