"""Phrase collocations: SON mining of candidates shard by shard, exact global counts, scores, coverage and the best of every language.

The tasks of a scan are dealt over a few shards. A phrase that occurs `support` times in all occurs at least ceil(support / shards) times in
some shard, so every shard is mined completely at that support, one phrase length after another: a phrase can only reach it if both its
parts without the last and without the first word do. The union of the shards' frequent phrases is kept as a bitmap of their hashes, of
bounded size: a collision or a full bitmap lets phrases through, never holds one back. At the end one pass counts by its text every phrase
that the bitmaps let through, which leaves exactly the frequent ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pandas.util import hash_array
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import documents, stash
from .word_bpe import blocks

SUPPORT = 30
WORDS = 4
SHARDS = 8
COVER_PERCENT = 80
TOP = 2000
# A bitmap has 16 bits for every phrase it holds, but never more than 2^28 bits (32 MB).
MOST_BITS = 28
BLOCK_BYTES = 8_000_000
SALTS = 16
_HASH_BITS = 60  # the upper four bits of a mined key name the shard
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BREAK = np.zeros(256, bool)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_INSIDE = ~_BREAK
_INSIDE[list(b" \t")] = False


def lang_text(docs: DataFrame) -> DataFrame:
    """lang, null as `und`, and text, null as empty."""
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def parted(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of all texts, the text of each, and whether it is the first of its piece."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    size = int(offsets[-1] - offsets[0])
    if not size:
        return pa.array([], pa.string()), np.empty(0, np.int64), np.empty(0, bool)
    data = _LOWER[np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]]
    offsets = offsets - offsets[0]
    inside = _INSIDE[data]
    border = np.zeros(size + 1, bool)
    border[offsets] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | border[1:-1]
    ends[:-1] &= ~inside[1:] | border[1:-1]
    starts = np.flatnonzero(begins)
    stops = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(np.flatnonzero(ends) + 1 - starts, out=stops[1:])
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(stops), pa.py_buffer(data[inside]))
    owner = np.searchsorted(offsets, starts, "right") - 1
    breaks = np.cumsum(_BREAK[data], dtype=np.int32)[starts]
    first = np.ones(len(starts), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (breaks[1:] != breaks[:-1])
    return words, owner, first


def numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different keys, the number of each key among them, and how often each occurs."""
    coded = pa.array(keys, pa.int64()).dictionary_encode()
    number = np.asarray(coded.indices, np.int64)
    return np.asarray(coded.dictionary, np.int64), number, np.bincount(number, minlength=len(coded.dictionary))


def word_hashes(langs: pa.Array, words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each pair."""
    coded = langs.dictionary_encode()
    seeds = hash_array(coded.dictionary.to_numpy(zero_copy_only=False), categorize=False)[np.asarray(coded.indices, np.int64)] if len(langs) else np.empty(0, np.uint64)
    return _mixed(hash_array(words.to_numpy(zero_copy_only=False), categorize=False) if len(words) else seeds, seeds)


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = (a ^ a >> np.uint64(29)) * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return out * np.uint64(0xD6E8FEB86659FD93)


class Bitmap:
    """Hashes by their upper bits. `passes` is true for every hash it was made of, and for few others while it is not full."""

    def __init__(self, bits: int, slots: np.ndarray):
        self.bits, self.slots = bits, slots

    def passes(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> np.uint64(64 - self.bits)
        return self.slots[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1) == 1


def bitmap(hashes: DataFrame) -> Bitmap:
    """Of a stored column `hash`, whose upper 60 bits count. The driver gets at most 2^22 slots."""
    rows = hashes.count()
    bits = min(max((16 * rows).bit_length(), 12), MOST_BITS)
    at = F.shiftrightunsigned("hash", 64 - bits)
    slots = hashes.select(at.alias("at")).select(F.shiftright("at", 6).cast("int").alias("slot"), F.expr("shiftleft(1L, cast(at & 63 AS int))").alias("bit"))
    found = slots.groupBy("slot").agg(F.bit_or("bit").alias("bit")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[found.column("slot").to_numpy()] = found.column("bit").to_numpy().view(np.uint64)
    return Bitmap(bits, out)


class Block:
    """The words of a block of texts as numbers; a number stands for a word in a language."""

    def __init__(self, batch: pa.RecordBatch):
        words, owner, first = parted(batch.column("text"))
        langs = batch.column("lang").dictionary_encode()
        coded = words.dictionary_encode()
        width = max(len(coded.dictionary), 1)
        keys, self.unit, _ = numbered(np.asarray(langs.indices, np.int64)[owner] * width + np.asarray(coded.indices, np.int64))
        self.lang = langs.dictionary.take(pa.array(keys // width))
        self.word = coded.dictionary.take(pa.array(keys % width))
        self.first = first

    def hashes(self) -> np.ndarray:
        return word_hashes(self.lang, self.word)

    def levels(self, filters: list[Bitmap], most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For 2 to `most` words: hashes, counts and words (as numbers) of the different phrases both whose parts pass the filters."""
        unit, units = self.unit, len(self.word)
        single = hashes = self.hashes()
        code, parts = unit, np.arange(units)[:, None]
        good = filters[0].passes(hashes)[code] if units else np.empty(0, bool)
        for n in range(2, most + 1):
            at = np.flatnonzero(good[: 1 - n] & good[1 : len(good) - n + 2] & ~self.first[n - 1 :]) if len(good) >= n else np.empty(0, np.int64)
            keys, inverse, counts = numbered(code[at] * units + unit[at + n - 1])
            before, last = np.divmod(keys, max(units, 1))
            parts = np.column_stack([parts[before], last])
            hashes = _mixed(hashes[before], single[last])
            yield hashes, counts, parts
            if n == most:
                return
            code, good = np.full(len(unit), -1, np.int64), np.zeros(len(unit), bool)
            code[at] = inverse
            good[at] = filters[n - 1].passes(hashes)[inverse]


def _blocks(batches) -> Iterator[Block]:
    for batch in batches:
        for block in blocks([batch], limit=BLOCK_BYTES):
            yield Block(block)


def word_counts(rows: DataFrame) -> DataFrame:
    """lang, phrase (one word; null: all words of the language), n."""

    def count(batches):
        for block in _blocks(batches):
            n = np.bincount(block.unit, minlength=len(block.word))
            yield pa.RecordBatch.from_arrays([block.lang, block.word, pa.array(n, pa.int64())], names=["lang", "phrase", "n"])
            totals = pa.table([block.lang, pa.array(n, pa.int64())], names=["lang", "n"]).group_by("lang").aggregate([("n", "sum")])
            yield pa.RecordBatch.from_arrays(
                [totals["lang"].combine_chunks(), pa.nulls(len(totals), pa.string()), totals["n_sum"].combine_chunks()], names=["lang", "phrase", "n"]
            )

    return rows.mapInArrow(count, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def hashed(single: DataFrame) -> DataFrame:
    """`hash` of the frequent words."""

    def run(batches):
        for batch in batches:
            found = word_hashes(batch.column("lang"), batch.column("phrase"))
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], names=["hash"])

    return single.select("lang", "phrase").mapInArrow(run, "hash long")


def _sent(rows: DataFrame, filters: list[Bitmap]):
    """The bitmaps as plain values, which workers read without this package."""
    return rows.sparkSession.sparkContext.broadcast([(f.bits, f.slots) for f in filters])


def mined(rows: DataFrame, filters: list[Bitmap], support: int, shards: int) -> DataFrame:
    """`hash` of every phrase of len(filters) + 1 words that is frequent in some shard."""
    if not 1 <= shards <= 1 << (64 - _HASH_BITS):
        raise ValueError("between 1 and 16 shards")
    held, n = _sent(rows, filters), len(filters) + 1

    def mine(batches):
        known = [Bitmap(*parts) for parts in held.value]
        shard = np.uint64(TaskContext.get().partitionId() % shards)
        for block in _blocks(batches):
            hashes, counts, _ = list(block.levels(known, n))[-1]
            keys = hashes >> np.uint64(64 - _HASH_BITS) | shard << np.uint64(_HASH_BITS)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts, pa.int64())], names=["key", "n"])

    frequent = rows.mapInArrow(mine, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= -(-support // shards))
    return frequent.select(F.shiftleft("key", 64 - _HASH_BITS).alias("hash")).distinct()


def counted(rows: DataFrame, filters: list[Bitmap], support: int) -> DataFrame:
    """lang, phrase, n of every phrase of 2 to len(filters) words that occurs often enough, counted by its text."""
    held, most = _sent(rows, filters), len(filters)

    def count(batches):
        known = [Bitmap(*parts) for parts in held.value]
        for block in _blocks(batches):
            for n, (hashes, counts, parts) in enumerate(block.levels(known, most), 2):
                ok = known[n - 1].passes(hashes)
                columns = [block.word.take(pa.array(part)) for part in parts[ok].T]
                phrase = pc.binary_join_element_wise(*columns, " ")
                yield pa.RecordBatch.from_arrays([block.lang.take(pa.array(parts[ok, 0])), phrase, pa.array(counts[ok], pa.int64())], names=["lang", "phrase", "n"])

    exact = rows.mapInArrow(count, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    return exact.where(F.col("n") >= support)


def frequent_phrases(docs: DataFrame, support: int = SUPPORT, words: int = WORDS, shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n) of all frequent phrases of 1 to `words` words; (lang, n) all words of a language. Both are stored."""
    rows = lang_text(docs)
    single = stash(word_counts(rows).where(F.col("phrase").isNull() | (F.col("n") >= support)), "phrase-words")
    totals, single = single.where(F.col("phrase").isNull()).select("lang", "n"), single.where(F.col("phrase").isNotNull())
    filters = [bitmap(stash(hashed(single), "phrase-word-hashes"))]
    for n in range(2, words + 1):
        filters.append(bitmap(stash(mined(rows, filters, support, shards), f"phrase-mined-{n}")))
    return single.unionByName(stash(counted(rows, filters, support), "phrase-counts")), totals


def scored(frequent: DataFrame, words: int = WORDS, cover_percent: int = COVER_PERCENT) -> DataFrame:
    """lang, phrase, a, l, r, score of the candidates that no longer candidate covers."""
    parts = frequent.withColumn("size", F.size(F.split("phrase", " ")))
    list_of = F.split("phrase", " ")

    def stretch(start, length) -> Column:
        return F.array_join(F.slice(F.col("list"), start, length), " ")

    longer = parts.where("size > 1").withColumn("list", list_of)
    cuts = longer.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    left = F.struct(F.lit("l").alias("side"), stretch(F.lit(1), F.col("k")).alias("part"))
    right = F.struct(F.lit("r").alias("side"), stretch(F.col("k") + 1, F.col("size") - F.col("k")).alias("part"))
    asked = cuts.select("lang", "phrase", "k", F.explode(F.array(left, right)).alias("s")).select("lang", "phrase", "k", "s.side", "s.part")
    # Few words end or begin very many phrases, so the rows that ask for a word and its count are dealt over salts.
    is_word = ~F.contains("part", F.lit(" "))
    asked = asked.withColumn("salt", F.when(is_word, F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).otherwise(0).cast("int"))
    answers = parts.select(
        "lang", F.col("phrase").alias("part"), "n", F.explode(F.when(F.col("size") == 1, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))).alias("salt")
    )
    found = asked.join(answers, ["lang", "part", "salt"]).select("lang", "phrase", "k", "side", "n")
    inner = [(i, m) for m in range(2, words) for i in range(1, words - m + 2)]
    covered = F.filter(F.array(*[F.when((F.lit(i + m - 1) <= F.col("size")) & (F.lit(m) < F.col("size")), stretch(F.lit(i), F.lit(m))) for i, m in inner]), lambda p: p.isNotNull())
    covers = longer.where("size > 2").select("lang", F.explode(covered).alias("phrase"), "n")
    facts = (
        found.unionByName(parts.where("size > 1").select("lang", "phrase", F.lit("a").alias("side"), "n"), allowMissingColumns=True)
        .unionByName(covers.select("lang", "phrase", F.lit("cover").alias("side"), "n"), allowMissingColumns=True)
    )

    def of(side: str, k: int | None = None) -> Column:
        return F.max(F.when((F.col("side") == side) & (F.lit(True) if k is None else F.col("k") == k), F.col("n")))

    sums = [of(side, k).alias(f"{side}{k}") for k in range(1, words) for side in "lr"]
    rows = facts.groupBy("lang", "phrase").agg(of("a").alias("a"), of("cover").alias("cover"), *sums)
    wide = "decimal(38,0)"
    choices = [
        F.when(
            F.col(f"l{k}").isNotNull(),
            F.struct(F.expr(f"(2000000 * cast(a AS {wide})) div (cast(l{k} AS {wide}) + cast(r{k} AS {wide}))").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")),
        )
        for k in range(1, words)
    ]
    lowest = F.array_min(F.filter(F.array(*choices), lambda c: c.isNotNull()))
    loose = F.col("cover").isNull() | (100 * F.col("cover").cast(wide) < cover_percent * F.col("a").cast(wide))
    return rows.where(F.col("a").isNotNull() & loose).withColumn("best", lowest).select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def collocations(
    docs: DataFrame, support: int = SUPPORT, words: int = WORDS, shards: int = SHARDS, cover_percent: int = COVER_PERCENT, top: int = TOP
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best `top` phrases of every language.

    Null texts are empty, a null lang is `und`; empty texts and tables give no phrases. Repeated rows count again. A text of any length
    counts whole (as one block, if it is longer than a block). Equal scores are ordered by count, then by the bytes of the phrase, and no two rows of a
    language are equal in all of these. Columns other than lang and text are ignored.
    """
    frequent, totals = frequent_phrases(docs, support, words, shards)
    order = W.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    best = scored(frequent, words, cover_percent).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
places AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM words),
f AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS n
  FROM places, (SELECT unnest(range(1, 5)) AS k) WHERE i + k - 1 <= len(ws) GROUP BY ALL
),
cand AS (SELECT lang, k AS size, phrase, n AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND n >= 30),
cuts AS (SELECT *, unnest(range(1, size)) AS k FROM cand),
scores AS (
  SELECT c.lang, c.phrase, c.a, c.k, fl.n AS l, fr.n AS r, (2000000::HUGEINT * c.a) // (fl.n::HUGEINT + fr.n) AS score
  FROM cuts c
  JOIN f fl ON fl.lang = c.lang AND fl.phrase = array_to_string(c.ws[1:c.k], ' ')
  JOIN f fr ON fr.lang = c.lang AND fr.phrase = array_to_string(c.ws[c.k + 1:c.size], ' ')
),
lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_runs AS (
  SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, max(a) AS cover
  FROM cand, (SELECT unnest(range(1, 4)) AS i), (SELECT unnest(range(2, 4)) AS m) WHERE m < size AND i + m - 1 <= size GROUP BY ALL
),
kept AS (SELECT lowest.* FROM lowest LEFT JOIN inner_runs USING (lang, phrase) WHERE cover IS NULL OR 100::HUGEINT * cover < 80::HUGEINT * a),
total AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM kept JOIN total USING (lang) QUALIFY rank <= 2000
"""
