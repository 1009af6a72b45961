import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from basketflow.llm.target_sampling import SpanCrc, op13_target_sampling, target_sample

from .conftest import ODD, SF

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def feats(text, runs=(1, 1)):
    words = WORD.findall((text or "").translate(ASCII_LOWER))
    return words, [" ".join(words[i : i + n]) for n in range(runs[0], runs[1] + 1) for i in range(len(words) - n + 1)]


def brute(docs, bench, buckets=10_000, runs=(1, 1), percent=10, min_words=20):
    """(doc_id, n_words, n_features, weight, score) of every row and the ordered ids and scores of the drawn ones."""

    def bucket(feature):
        return zlib.crc32(feature.encode()) % buckets

    raw = Counter(bucket(f) for _, t in docs for f in feats(t, runs)[1])
    target = Counter(bucket(f) for t in bench for f in feats(t, runs)[1])
    s, t = sum(raw.values()) + buckets, sum(target.values()) + buckets
    rows = []
    for i, text in docs:
        words, found = feats(text, runs)
        weight = sum(math.floor(1000 * math.log((target[b] + 1) * s / ((raw[b] + 1) * t))) for b in map(bucket, found))
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(words), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0]))
    return rows, [(r[0], r[4]) for r in able[: len(able) * percent // 100]]


def same(result, want):
    rows, taken = want
    got = result.collect()
    key = lambda r: (r[0] is None, r)
    assert sorted([tuple(r)[:5] for r in got], key=key) == sorted(rows, key=key)
    ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(taken) + 1))
    assert [(r["doc_id"], r["score"]) for r in ranked] == taken


@pytest.mark.parametrize("reach", [4, 7, 64])
def test_crc_of_spans(reach):
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 50_000, dtype=np.uint8)
    starts = rng.integers(0, 30_000, 300)
    ends = starts + np.r_[rng.integers(0, 3 * reach, 280), rng.integers(0, 20_000, 20)]
    assert SpanCrc(reach)(data, starts, ends).tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends)]


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    bench = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows, taken = brute(docs, bench)
    got = op13_target_sampling(spark, SF)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {t for _, t in got.dtypes} == {"bigint"}
    found = {r.doc_id: r for r in got.collect()}
    assert {i: (f, w, s) for i, _, f, w, s in rows} == {i: (r.n_features, r.weight, r.score) for i, r in found.items()}
    assert [i for i, _ in taken] == sorted((i for i, r in found.items() if r["rank"]), key=lambda i: found[i]["rank"])


@pytest.mark.parametrize("runs", [(1, 1), (1, 3), (2, 2)])
def test_odd_rows_ties_and_long_words(spark, odd, runs):
    extra = [(20, "Ab" * 40_000 + " x " * 30), (None, "same words " * 15), (None, "same words " * 15), (30, "same words " * 15), (31, "日本語テキスト" * 500 + " A" * 25)]
    docs = [(r.doc_id, r.text) for r in odd.collect()] + extra
    table = odd.unionByName(spark.createDataFrame([(i, t, None, None, None, "n", "d", 1, 7, 0, "r", False, 3) for i, t in extra], ODD)).withColumns(
        {"tie": odd.salt, "place": odd.salt, "rank": odd.salt, "score": odd.salt, "bucket": odd.salt}
    )
    bench = ["word same 日本語", None, "", "One TWO three"]
    target = spark.createDataFrame([(t, "x") for t in bench], "text string, bucket string")
    same(target_sample(table, target, buckets=97, runs=runs, percent=60), brute(docs, bench, 97, runs, 60))


def test_repeated_rows_share_a_rank_order(spark):
    """Full ties over many tasks: every row is there, ranks have no gap and no repeat."""
    docs = spark.range(400).selectExpr("7L AS doc_id", "repeat('a word ', 20) AS text").repartition(6)
    ranks = sorted(r["rank"] for r in target_sample(docs, docs.limit(1)).collect() if r["rank"] is not None)
    assert ranks == list(range(1, 41))


def test_empty_tables(spark, odd, none):
    assert target_sample(none, odd).count() == 0
    rows = target_sample(odd, none).collect()
    assert len(rows) == 12 and sum(r["rank"] is not None for r in rows) == 0
