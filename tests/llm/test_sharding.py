import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from basketflow.llm.sharding import balanced_shards, minimax_cuts


def needs(sizes, capacity):
    shards, held = 1, 0
    for s in sizes:
        if held + s > capacity:
            shards, held = shards + 1, 0
        held += s
    return shards


def least(sizes, shards):
    low, high = max(sizes, default=0), sum(sizes)
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if needs(sizes, mid) <= shards else (mid + 1, high)
    return low


@pytest.mark.parametrize("seed", range(8))
def test_cuts_are_the_greedy_ones_at_the_least_capacity(seed):
    rng = random.Random(seed)
    n, shards = rng.choice([1, 5, 300, 20_000]), rng.choice([1, 2, 16])
    groups = sorted((hashlib.sha256(f"{seed} {i}".encode()).hexdigest(), rng.choice([1, 9, 1000, 10 ** rng.randint(1, 5)])) for i in range(n))
    asked = []

    def look(prefixes, width):
        out = defaultdict(list)
        for key, size in groups:
            if prefixes is None or key[: len(prefixes[0])] in prefixes:
                out[key[:width]].append(size)
        asked.append(len(out))
        return [(k, sum(v), len(v), max(v)) for k, v in out.items()]

    firsts, capacity = minimax_cuts(look, shards)
    sizes = [s for _, s in groups]
    assert capacity == least(sizes, shards)
    loads = [0] * shards
    for key, size in groups:
        loads[sum(key >= f for f in firsts)] += size
    assert max(loads) <= capacity
    expected, held = [0], 0
    for s in sizes:
        if held + s > capacity:
            expected.append(0)
            held = 0
        expected[-1] += s
        held += s
    assert [x for x in loads if x] == expected


def check(df, shards=16):
    rows, found = df.collect(), balanced_shards(df, shards).collect()
    key = lambda r: str((r.doc_id, r.text))
    assert sorted((str(r.doc_id), len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in rows) == sorted((str(r.doc_id), r.size, r.text_crc32) for r in found)
    by_shard, by_text = defaultdict(list), defaultdict(set)
    for r in found:
        by_shard[r.shard].append(r.slot)
        by_text[r.digest].add(r.shard)
        assert (r.law, r.grown_shard) == ("bytes", None) and 0 <= r.shard < shards
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())
    assert all(len(v) == 1 for v in by_text.values())
    groups = defaultdict(int)
    for r in sorted(rows, key=key):
        groups[hashlib.sha256((r.text or "").encode()).hexdigest()] += len((r.text or "").encode()) + 1
    loads = defaultdict(int)
    for r in found:
        loads[r.shard] += r.size
    assert max(loads.values(), default=0) <= least([groups[k] for k in sorted(groups)], shards)


def test_documents(docs):
    check(docs)


def test_odd_rows(odd, none):
    check(odd)
    check(odd, 2)
    assert balanced_shards(none).collect() == []


def test_slots_have_no_gap_when_all_ids_are_null(spark, monkeypatch):
    from basketflow.llm import sharding

    monkeypatch.setattr(sharding, "BUCKET_ROWS", 3)
    docs = spark.range(700).selectExpr("cast(null as long) AS doc_id", "concat('text ', id % 50) AS text")
    slots = {}
    for r in sharding.balanced_shards(docs, 4).collect():
        slots.setdefault(r.shard, []).append(r.slot)
    assert sum(map(len, slots.values())) == 700 and all(sorted(s) == list(range(len(s))) for s in slots.values())
