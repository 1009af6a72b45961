import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from basketflow.llm.packing import best_fit_packing, plan, sequences
from basketflow.llm.token_counts import token_counts

LIBRARY = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def check(rows, packed, capacity):
    """Every piece is there, as the library has it, and sequences are filled without gaps."""
    expected = Counter()
    for doc, text in rows:
        ids = np.array([*ids_of(text), 0], "<u4")
        expected.update((doc, k, at, len(ids[at : at + capacity]), zlib.crc32(ids[at : at + capacity].tobytes())) for k, at in enumerate(range(0, len(ids), capacity)))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == expected
    held = {}
    for r in packed:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


def test_documents(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = best_fit_packing(docs).collect()
    used = check(rows, found, 2048)
    assert used <= -(-sum(r.length for r in found) // 2048) + 2


def test_odd_rows(odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    check(rows, best_fit_packing(odd).collect(), 2048)
    check(rows, best_fit_packing(odd, capacity=3).collect(), 3)
    assert best_fit_packing(none).collect() == []


def test_sequences_hold_the_ids(docs):
    packed = best_fit_packing(docs.limit(30), with_ids=True)
    found = {r.sequence_id: r.ids for r in sequences(packed).collect()}
    for r in packed.collect():
        assert found[r.sequence_id][r.offset : r.offset + r.length] == r.ids
    assert sum(map(len, found.values())) == sum(len(r.ids) for r in packed.collect())


def used_by(counts, capacity):
    patterns = plan(counts, capacity)
    assert all(sum(p) <= capacity and n > 0 for p, n in patterns)
    used = Counter()
    for p, n in patterns:
        for x in p:
            used[x] += n
    assert used == Counter({k: v for k, v in counts.items() if v})
    return sum(n for _, n in patterns)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(0, 9)))
def test_plan_uses_each_length_as_often_as_there_are(counts):
    used_by(counts, 30)


@pytest.mark.parametrize("times", [1, 10**9])
def test_plan_is_near_the_least(times):
    rng = random.Random(3)
    counts = Counter()
    for _ in range(5000):
        counts[min(2048, int(rng.expovariate(1 / 500)) + 1)] += times
    least = -(-sum(k * v for k, v in counts.items()) // 2048)
    assert used_by(counts, 2048) <= least * 1.002 + 1
    assert len(plan(counts, 2048)) < 4 * 2048


def test_counts_of_documents(docs, odd, none):
    for df in (docs, odd):
        texts = Counter((r.doc_id, len((r.text or "").encode()), len(ids_of(r.text)), len(ids_of(r.text)) > 2048) for r in df.collect())
        assert Counter(tuple(r) for r in token_counts(df).collect()) == texts
    assert token_counts(none).collect() == []


def test_one_id_on_all_rows_is_packed_whole(spark):
    from basketflow.llm.packing import pack

    rows = spark.range(900).selectExpr("cast(null as long) AS doc_id", "0 AS piece", "cast(1 + id % 60 as long) AS length", "id AS spread", "7 AS Spread_")
    placed = pack(rows, 64)
    assert placed.columns == [*rows.columns, "sequence_id", "offset"]
    held = {}
    for r in placed.collect():
        held.setdefault(r.sequence_id, []).append((r.offset, r.length, r.spread))
    assert sorted(s for parts in held.values() for *_, s in parts) == list(range(900))
    for parts in held.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
