"""URLs by rules, and beyond them by the likelihood ratio of character models of accepted and rejected URLs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import rows_of, stash

# (verdict, host and path).
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
ORDER = 5
# Bits of the hash that names a context, or a context with its next byte: wide enough that each has a name of its own.
BITS = 63
# Contexts that a task holds before it counts them.
ENTRIES = 1_000_000
# A gram that more urls have is hot.
HOT = 100_000
# Share of the accepted held-out URLs that the cut may reject at most.
LOSS = 0.01
_MUL = np.uint64(0x9E3779B97F4A7C15)


def parts(url: Column) -> tuple[Column, Column]:
    """(host with A to Z lower-cased, path); both empty for null or without ://."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null if none does."""
    rule = verdict = None
    for said, text in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, slash, start = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + start)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, said) if verdict is None else verdict.when(fits, said)
    return (F.lit(None).cast("string"), F.lit(None).cast("string")) if rule is None else (rule, verdict)


def contexts(url: str, order: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots of each byte's contexts of 0 to order bytes, and of these contexts with the byte; one row per context length."""
    data = np.frombuffer(b"\0" * order + url.encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint64)
    n = len(data) - order
    context, with_byte = np.empty((order + 1, n), np.int64), np.empty((order + 1, n), np.int64)
    key = np.zeros(n, np.uint64)
    for k in range(order + 1):
        if k:
            key = (key ^ (data[order - k : order - k + n] + np.uint64(1))) * _MUL
            key ^= key >> np.uint64(31)
        salted = (key + np.uint64(k + 1)) * _MUL
        joined = (salted ^ (data[order:] + np.uint64(257))) * _MUL
        joined ^= joined >> np.uint64(29)
        context[k] = (salted * _MUL >> np.uint64(64 - bits)).astype(np.int64)
        with_byte[k] = (joined * _MUL >> np.uint64(64 - bits)).astype(np.int64)
    return context, with_byte


def counted(rows: DataFrame, order: int, bits: int) -> DataFrame:
    """good, k, joined, context, n: per class (0 rejected, 1 accepted) how often each context of k bytes occurs with its next byte in `url`. Stored.

    The table holds what occurs, so it grows with the different contexts of the input; it stays where it is.
    """

    def count(batches):
        held, entries = ([], []), 0

        def parts():
            for good in (0, 1):
                if held[good]:
                    k = np.concatenate([np.repeat(np.arange(order + 1), j.shape[1]) for _, j in held[good]])
                    joined, at, n = np.unique(np.concatenate([j.ravel() for _, j in held[good]]), return_index=True, return_counts=True)
                    context = np.concatenate([c.ravel() for c, _ in held[good]])[at]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), good, np.int32)), pa.array(k[at].astype(np.int32)), pa.array(joined), pa.array(context), pa.array(n)], names=["good", "k", "joined", "context", "n"]
                    )
                    held[good].clear()

        for url, good in rows_of(batches, "url", "good"):
            context, joined = contexts(url, order, bits)
            held[good].append((context, joined))
            entries += joined.size
            if entries >= ENTRIES:
                yield from parts()
                entries = 0
        yield from parts()

    tuples = rows.mapInArrow(count, "good int, k int, joined long, context long, n long")
    return stash(tuples.groupBy("good", "k", "joined", "context").agg(F.sum("n").alias("n")), "url-counts")


def asked(urls: DataFrame, order: int, bits: int) -> DataFrame:
    """gram, k, joined, context of the different places of the urls: a gram names a byte with the `order` bytes before it. Stored."""

    def run(batches):
        held, entries = [], 0

        def parts():
            grams = np.concatenate([j[order] for _, j in held])
            grams, at = np.unique(grams, return_index=True)
            joined, context = (np.concatenate([x[i] for x in held], axis=1)[:, at] for i in (1, 0))
            k = np.repeat(np.arange(order + 1, dtype=np.int32), len(at))
            yield pa.RecordBatch.from_arrays([pa.array(np.tile(grams, order + 1)), pa.array(k), pa.array(joined.ravel()), pa.array(context.ravel())], names=["gram", "k", "joined", "context"])
            held.clear()

        for (url,) in rows_of(batches, "url"):
            if url:
                held.append(contexts(url, order, bits))
                entries += held[-1][1].size
                if entries >= ENTRIES:
                    yield from parts()
                    entries = 0
        if held:
            yield from parts()

    return stash(urls.mapInArrow(run, "gram long, k int, joined long, context long").distinct(), "url-asked")


def gram_ratios(counts: DataFrame, grams: DataFrame) -> DataFrame:
    """gram, ratio: ln P(accepted) - ln P(rejected) of a byte behind the bytes before it. Stored.

    A byte's probability mixes all context lengths: each longer context keeps to what it has seen, and leaves to the shorter one the
    share of its different followers (Witten-Bell). Contexts of up to one byte, of which there are few and which all grams ask for, are broadcast
    (at most 257 contexts with 65,792 next bytes); the others meet by shuffle.
    """

    def of(good: int, value: Column) -> Column:
        return F.sum(F.when(F.col("good") == good, value).otherwise(0))

    classes = (("bad", 0), ("good", 1))
    next_byte = counts.groupBy("k", "joined").agg(*[of(c, F.col("n")).alias(f"n_{name}") for name, c in classes])
    before = counts.groupBy("k", "context").agg(
        *[of(c, F.col("n")).alias(f"total_{name}") for name, c in classes], *[of(c, F.lit(1)).alias(f"follow_{name}") for name, c in classes]
    )
    parts = []
    for few in (True, False):
        some = F.col("k") <= 1 if few else F.col("k") > 1
        rows = grams.where(some)
        for side, key in ((next_byte, "joined"), (before, "context")):
            side = side.where(some).drop("k")
            rows = rows.join(F.broadcast(side) if few else side.hint("merge"), key, "left")
        parts.append(rows)
    values = [f"{what}_{name}" for name, _ in classes for what in ("n", "total", "follow")]
    facts = parts[0].unionByName(parts[1]).select("gram", "k", *[F.coalesce(F.col(v), F.lit(0)).cast("double").alias(v) for v in values])
    listed = facts.groupBy("gram").agg(F.array_sort(F.collect_list(F.struct("k", *values))).alias("of"))

    def probability(name: str) -> Column:
        def longer(p: Column, x: Column) -> Column:
            n, total, follow = (x[f"{what}_{name}"] for what in ("n", "total", "follow"))
            return F.when(total > 0, (n + follow * p) / (total + follow)).otherwise(p)

        return F.aggregate("of", F.lit(1 / 256), longer)

    return stash(listed.select("gram", (F.ln(probability("good")) - F.ln(probability("bad"))).alias("ratio")), "url-grams")


def url_ratios(urls: DataFrame, ratios: DataFrame, order: int, bits: int) -> DataFrame:
    """url_key, ratio: mean over the bytes of each url (url_key, url) of its grams' ratios, to nine digits.

    Grams that very many urls have (as of a scheme) are taken out before the shuffle: their ratios are broadcast, no more of them than all
    places of all urls by HOT. Sums are decimal, so their order doesn't matter.
    """

    def run(batches):
        held, entries = [], 0

        def parts():
            sizes = [len(grams) for _, _, grams, _ in held]
            keys = pa.DictionaryArray.from_arrays(pa.array(np.repeat(np.arange(len(held), dtype=np.int32), sizes)), pa.array([key for key, *_ in held], pa.string()))
            columns = [np.repeat([n for _, n, *_ in held], sizes), *(np.concatenate([h[i] for h in held]) for i in (2, 3))]
            yield pa.RecordBatch.from_arrays([keys.cast(pa.string()), *(pa.array(c, pa.int64()) for c in columns)], names=["url_key", "bytes", "gram", "times"])
            held.clear()

        for key, url in rows_of(batches, "url_key", "url"):
            grams, times = np.unique(contexts(url, order, bits)[1][order], return_counts=True)
            held.append((key, len(url.encode("utf-8", "surrogatepass")), grams, times))
            entries += len(grams)
            if entries >= ENTRIES // 4:
                yield from parts()
                entries = 0
        if held:
            yield from parts()

    places = stash(urls.filter("url <> ''").mapInArrow(run, "url_key string, bytes long, gram long, times long"), "url-places")
    often = places.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > HOT).select("gram")
    hot = stash(ratios.join(often, "gram"), "url-hot")
    found = places.join(F.broadcast(hot), "gram").unionByName(places.join(F.broadcast(hot.select("gram")), "gram", "left_anti").join(ratios.hint("merge"), "gram").select("gram", "url_key", "bytes", "times", "ratio"))
    total = F.sum(F.col("ratio").cast("decimal(20,14)") * F.col("times").cast("decimal(16,0)"))
    return found.groupBy("url_key").agg(F.round(total.cast("double") / F.first("bytes"), 9).alias("ratio"))


def calibrated_cut(held: DataFrame, loss: float) -> float:
    """The cut from all rows of held (good, ratio): the ratio that best parts accepted (good 1) and rejected ones (0), lowered if it would reject
    more than the share `loss` of the accepted; 0 without rows of both kinds.

    Best is the greatest sum of (share of accepted at or above, share of rejected below), the lowest of several, in the middle between it and
    the next lower ratio. Rows are counted per ratio, ratios lie in ranges, and the counts below one are those of the lower ranges and of its own.
    """
    good, bad = held.agg(F.count_if(F.col("good") == 1), F.count_if(F.col("good") == 0)).first()
    if not good or not bad:
        return 0.0
    counts = held.groupBy("ratio").agg(F.count_if(F.col("good") == 1).alias("g"), F.count_if(F.col("good") == 0).alias("b"))
    ranged = stash(counts.repartitionByRange("ratio").withColumn("range", F.spark_partition_id()), "url-cuts")
    lower = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)  # one row per range
    ranges = ranged.groupBy("range").agg(F.sum("g").alias("g"), F.sum("b").alias("b"))
    ranges = ranges.select("range", *[F.coalesce(F.sum(c).over(lower), F.lit(0)).alias(f"{c}_lower") for c in "gb"])
    upto = W.partitionBy("range").orderBy("ratio").rowsBetween(W.unboundedPreceding, 0)
    sums = ranged.join(F.broadcast(ranges), "range").select("ratio", "g", "b", *[(F.col(f"{c}_lower") + F.sum(c).over(upto)).alias(f"{c}_upto") for c in "gb"])
    parted = (good - (F.col("g_upto") - F.col("g"))) / F.lit(float(good)) + (F.col("b_upto") - F.col("b")) / F.lit(float(bad))
    best, most = sums.agg(F.max(F.struct(parted.alias("parted"), (-F.col("ratio")).alias("low"))), F.min(F.when(F.col("g_upto") > int(loss * good), F.col("ratio")))).first()
    at = -best.low
    below = ranged.filter(F.col("ratio") < at).agg(F.max("ratio")).first()[0]
    return min(at if below is None else (below + at) / 2, most)


def url_verdicts(pages: DataFrame, rules: list[tuple[str, str]] = RULES, order: int = ORDER, bits: int = BITS, loss: float = LOSS) -> DataFrame:
    """Every row of pages: page_id, host, path, rule, verdict, ratio.

    URLs that a rule fits are accepted or rejected by the longest one (ties by name). They also teach the two models: all of them
    but a held-out tenth (by hash of the URL). The cut is the one that best parts all accepted and rejected rows of that tenth, lowered if it would reject more than
    the share `loss` of the accepted (0 if the tenth lacks one kind). URLs without a rule are allowed if their ratio reaches the cut. Without rule-judged URLs of both kinds the ratio is 0 and they are allowed.
    Null and empty URLs have empty host and path and ratio 0, and are allowed if 0 reaches the cut. Equal URLs get equal verdicts. Repeated rows and null page_ids
    are judged like others. No rows give no rows. Other columns are ignored.
    """
    urls = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    host, path = parts(F.col("url"))
    named = urls.withColumn("host", host).withColumn("path", path)
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    judged = named.withColumn("rule", rule).withColumn("by_rule", verdict)
    known = judged.filter("by_rule is not null").select("url", (F.col("by_rule") == "allow").cast("int").alias("good"), (F.pmod(F.xxhash64("url", F.lit("held")), F.lit(10)) == 0).alias("held"))
    counts = counted(known.filter("not held"), order, bits)
    if counts.select("good").distinct().count() < 2:
        return judged.select("page_id", "host", "path", "rule", F.coalesce("by_rule", F.lit("allow")).alias("verdict"), F.lit(0.0).alias("ratio"))
    keyed = judged.withColumn("url_key", F.md5(F.encode("url", "UTF-8")))
    different = stash(keyed.filter("url <> ''").groupBy("url_key").agg(F.first("url").alias("url")), "urls")
    found = url_ratios(different, gram_ratios(counts, asked(different, order, bits)), order, bits)
    scored = keyed.join(found.hint("merge"), "url_key", "left").drop("url_key").withColumn("ratio", F.coalesce("ratio", F.lit(0.0)))
    scored = stash(scored.withColumn("_hash", F.xxhash64("url", F.lit("held"))), "ratios")
    held = scored.filter("by_rule is not null").filter(F.pmod("_hash", F.lit(10)) == 0)
    cut = calibrated_cut(held.select((F.col("by_rule") == "allow").cast("int").alias("good"), "ratio"), loss)
    return scored.select("page_id", "host", "path", "rule", F.coalesce("by_rule", F.when(F.col("ratio") >= cut, "allow").otherwise("block")).alias("verdict"), "ratio")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(spark.read.parquet(f"{sf_dir}/pages.parquet"))
