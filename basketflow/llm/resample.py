"""Quality by importance resampling: hashed n-gram models of target and raw text, sampled by Gumbel top-k."""

from __future__ import annotations

import ctypes
import math
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Memo, documents, gram_hashes, hash64, id_text, stash, worker_state
from .word_bpe import blocks

# The hashed models have 2^BITS slots for small corpora, and a slot a document for larger ones, up to 2^MOST_BITS: the size of what
# is summed, sent to the driver and broadcast.
BITS, MOST_BITS = 18, 20
# White space parts words; so does this many characters without any.
LONGEST = 24
# Labelled documents of either kind that target model and cut are taken from, at most.
SAMPLE = 20_000
# Weight of the raw model in the smoothed target model, in tokens per slot.
PRIOR = 1.0
BINS = 4_096
BLOCK_BYTES = 2_000_000

_RUN = re.compile(r"[^\W\d_]+|\d+")


def _case(letters: str) -> str:
    """A letter for the case of a run of letters, 9 for digits."""
    if letters.islower():
        return "a"
    if letters.isdigit():
        return "9"
    return "B" if len(letters) == 1 or letters[1:].islower() else "A" if letters.isupper() else "b"


def _tokens() -> Memo:
    """Chunk to two packed hashes: of its letters and digits, and of its shape (cases, digits, punctuation)."""
    shapes = Memo(lambda shape: hash64("\0" + shape).to_bytes(8, "little"), 25_000)

    def token(chunk: str) -> bytes:
        stem, mark = (chunk[:-1], chunk[-1]) if chunk[-1:] in (".", ",") else (chunk, "")
        if stem.isalpha():  # most chunks
            return hash64(stem.lower()).to_bytes(8, "little") + shapes[_case(stem) + mark]
        return hash64("".join(_RUN.findall(chunk.lower()))).to_bytes(8, "little") + shapes[_RUN.sub(lambda run: _case(run[0]), chunk)]

    return Memo(token, 120_000)


def block_slots(texts: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the texts' words and of their runs of one to three word shapes, as often as they occur, and the number of the text that each belongs to.

    Words are parted by white space, and every LONGEST characters where there is none. A word that repeats the one before has a shape of its own. A text's slots keep their order, whatever texts stand beside it.
    """
    split = pc.utf8_split_whitespace(pc.replace_substring_regex(texts, rf"(\S{{{LONGEST}}})", r"\1 "))
    coded = split.flatten().dictionary_encode()
    owner = np.repeat(np.arange(len(texts)), np.diff(np.asarray(split.offsets)))
    memo = worker_state("quality", "tokens", _tokens)
    made = np.frombuffer(b"".join([memo[c] for c in coded.dictionary.to_pylist()]), "<u8").reshape(-1, 2)
    codes = np.asarray(coded.indices)
    empty = coded.dictionary.index("").as_py()  # beside white space at an end
    if empty >= 0:
        codes, owner = codes[codes != empty], owner[codes != empty]
    if not len(codes):
        return np.empty(0, np.int64), owner
    word, shape = made[codes, 0], made[codes, 1]
    repeats = (word[1:] == word[:-1]) & (owner[1:] == owner[:-1])
    shape[1:][repeats] ^= np.uint64(0x5851F42D4C957F2D)
    hashes, owners = [gram_hashes(word, 1)], [owner]
    for n in (1, 2, 3):
        inside = owner[n - 1 :] == owner[: len(owner) - n + 1]
        hashes.append(gram_hashes(shape, n)[inside])
        owners.append(owner[: len(inside)][inside])
    return (np.concatenate(hashes) >> np.uint64(64 - bits)).astype(np.int64), np.concatenate(owners)


def _give_back() -> None:
    """Returns to the system what a block needed: idle workers would keep it beside the stages that follow."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def labelled(labels: DataFrame, limit: int = SAMPLE) -> DataFrame:
    """doc_id, quality and half (0 to fit, 1 to calibrate) of at most `limit` documents of either quality, by hash order of the id.

    A document with labels of both kinds counts as bad. Null ids and qualities are passed over.
    """
    rows = labels.filter("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(F.col("quality").cast("int")).alias("quality"))
    parts = [rows.filter(wanted).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit) for wanted in ("quality >= 1", "quality <= 0")]
    return parts[0].unionByName(parts[1]).withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)).cast("int"))


def ratio_table(docs: DataFrame, sample: DataFrame, bits: int = BITS, prior: float = PRIOR) -> np.ndarray:
    """Per slot the logarithm of its probability in target text over that in raw text.

    Raw counts come from every document, target counts from the fitting half of the good documents of the sample (bounded, so it is broadcast).
    The target model is smoothed towards the raw one.
    """
    good = sample.filter("half = 0 and quality >= 1").select("doc_id", F.lit(True).alias("target"))
    rows = id_text(docs).join(F.broadcast(good), "doc_id", "left").select("text", F.coalesce("target", F.lit(False)).alias("target"))

    def count(batches):
        held = np.zeros((2, 1 << bits), np.int64)
        for batch in blocks(batches, limit=BLOCK_BYTES):
            found, owner = block_slots(batch.column("text"), bits)
            target = np.asarray(batch.column("target").to_pylist(), bool)
            held[0] += np.bincount(found, minlength=1 << bits)
            held[1] += np.bincount(found[target[owner]], minlength=1 << bits)
            del found, owner, target
            _give_back()
        at = np.flatnonzero(held[0])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[0][at]), pa.array(held[1][at])], names=["slot", "raw", "target"])

    sums = rows.mapInArrow(count, "slot long, raw long, target long").groupBy("slot").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    counts = np.zeros((2, 1 << bits))
    found = sums.toArrow()  # at most 2^bits rows
    counts[:, found.column("slot").to_numpy()] = found.column("raw").to_numpy(), found.column("target").to_numpy()
    raw = (counts[0] + 0.5) / (counts[0] + 0.5).sum()
    weight = prior * (1 << bits)
    return np.log((counts[1] + weight * raw) / (counts[1].sum() + weight) / raw)


def log_weight(table: np.ndarray):
    """Column function: logarithm of a text's importance weight, to nine digits; 0 without words."""
    bits = int(math.log2(len(table)))

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        out = [np.empty(0)]
        for batch in blocks([pa.RecordBatch.from_arrays([text.fill_null("")], names=["text"])], limit=BLOCK_BYTES):
            found, owner = block_slots(batch.column("text"), bits)
            out.append(np.bincount(owner, weights=table[found], minlength=len(batch)))
            del found, owner
            _give_back()
        return pa.array(np.round(np.concatenate(out), 9), pa.float64())

    return score


def gumbel(seed: int) -> Column:
    """Noise of a standard Gumbel distribution that the document's id decides."""
    uniform = (F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.lit(seed)), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    return -F.log(-F.log(uniform))


def cut_between(good: list[float], bad: list[float]) -> float:
    """The cut with the best mean of (share of good at or above, share of bad below), in the middle where several are best.

    Without good or without bad ones nothing is cut off.
    """
    if not good or not bad:
        return -math.inf
    g, b = np.sort(good), np.sort(bad)
    at = np.unique(np.concatenate([g, b]))
    value = (len(g) - np.searchsorted(g, at)) / len(g) + np.searchsorted(b, at) / len(b)
    best = int(np.argmax(value))
    return float((at[best - 1] + at[best]) / 2) if best else float(at[0])


def kth_largest(df: DataFrame, column: str, k: int) -> float:
    """Exact k-th largest value of a column, by histograms that close in on it; minus infinity if there are no more than k rows, infinity for k < 1."""
    rows, low, high = df.agg(F.count(column), F.min(column), F.max(column)).first()
    if k < 1:
        return math.inf
    if rows <= k:
        return -math.inf
    above = 0  # values over `high`
    while True:
        inside = df.filter(F.col(column).between(low, high))
        if rows <= BINS or low == high:
            return low if low == high else sorted((r[0] for r in inside.select(column).collect()), reverse=True)[k - above - 1]
        part = F.least(F.lit(BINS - 1), F.floor((F.col(column) - low) / (high - low) * BINS)).alias("part")
        bins = inside.groupBy(part).agg(F.count(F.lit(1)), F.min(column), F.max(column)).collect()  # at most BINS rows
        for _, n, least, most in sorted(bins, reverse=True):
            if above + n >= k:
                rows, low, high = n, least, most
                break
            above += n


def model_bits(docs: DataFrame) -> int:
    return min(max(docs.count().bit_length(), BITS), MOST_BITS)


def resample(docs: DataFrame, labels: DataFrame, seed: int = 7, bits: int | None = None, sample: int = SAMPLE):
    """(scores, table, threshold): log_weight and gumbel_key of every row; the log ratios; the key that the chosen ones reach.

    k, the size of the sample, is the number of documents whose weight reaches the cut that best parts the calibrating half of the
    labelled documents. Documents with the k greatest keys (log weight plus Gumbel noise) are the sample without replacement.
    """
    known = stash(labelled(labels, sample), "labelled")
    table = ratio_table(docs, known, bits or model_bits(docs))
    scored = stash(id_text(docs).select("doc_id", log_weight(table)("text").alias("log_weight")).withColumn("gumbel_key", F.col("log_weight") + gumbel(seed)), "scores")
    held_out = scored.join(F.broadcast(known.filter("half = 1")), "doc_id").groupBy("doc_id", "quality").agg(F.min("log_weight").alias("log_weight"))
    held_out = held_out.select("log_weight", "quality").collect()  # a row per label, however often its document is there
    cut = cut_between([w for w, q in held_out if q >= 1], [w for w, q in held_out if q <= 0])
    k = scored.filter(F.col("log_weight") >= cut).count()
    return scored, table, kth_largest(scored, "gumbel_key", k)


def quality_sample(docs: DataFrame, labels: DataFrame, seed: int = 7) -> DataFrame:
    """Every row of docs: doc_id, log_weight, gumbel_key, kept.

    Null and empty texts have weight 1 (log 0). Rows with one text have one weight; noise depends on the doc_id only, so repeated rows stay or go
    together, as do rows with the very key at the edge (the sample may then be larger than k by them). Without labels of both kinds
    all rows are kept. No rows give no rows. Other columns are ignored.
    """
    scored, _, threshold = resample(docs, labels, seed)
    return scored.withColumn("kept", F.col("gumbel_key") >= F.lit(threshold))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_sample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def keep_sampled(spark: SparkSession, docs: DataFrame, sf_dir: str, seed: int = 7) -> DataFrame:
    """Pipeline stage: the sampled rows, all columns of docs. Keys are computed again beside the rows, which so need no join.

    Null and empty texts, ties and repeated rows are as in quality_sample: equal rows stay or go together, without labels all stay. No rows give
    no rows. Columns of docs may have any names, since none is added.
    """
    _, table, threshold = resample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), seed)
    key = log_weight(table)(F.coalesce(F.col("text").cast("string"), F.lit(""))) + gumbel(seed)
    return docs.filter(key >= F.lit(threshold))
