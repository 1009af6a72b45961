import random
import re
from collections import Counter

import duckdb
import pytest

from basketflow.llm.collocations import OP12_SQL, collocations, frequent_phrases, op12_collocations, scored

from .conftest import ODD, SF

ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def counts(docs, words):
    f, total = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(ASCII_LOWER)):
            ws = re.findall(r"[^ \t]+", piece)
            total[lang] += len(ws)
            for n in range(1, words + 1):
                f.update((lang, tuple(ws[i : i + n])) for i in range(len(ws) - n + 1))
    return f, total


def brute(docs, support=30, words=4, cover=80, top=2000):
    f, total = counts(docs, words)
    cand = {p: a for p, a in f.items() if a >= support and len(p[1]) > 1}
    covered = set()
    for (lang, ws), a in cand.items():
        for m in range(2, len(ws)):
            covered.update(p for i in range(len(ws) - m + 1) if 100 * a >= cover * f[p := (lang, ws[i : i + m])])
    rows = []
    for (lang, ws), a in cand.items():
        if (lang, ws) not in covered:
            score, _, l, r = min((2000000 * a // (f[lang, ws[:k]] + f[lang, ws[k:]]), k, f[lang, ws[:k]], f[lang, ws[k:]]) for k in range(1, len(ws)))
            rows.append((lang, -score, -a, " ".join(ws).encode(), l, r))
    out, rank = [], Counter()
    for lang, score, a, phrase, l, r in sorted(rows):
        rank[lang] += 1
        if rank[lang] <= top:
            out.append((lang, rank[lang], phrase.decode(), -a, l, r, total[lang], -score))
    return out


def made(seed, rows=120):
    rng = random.Random(seed)
    vocabulary = ["The", "of", "é", "日本", "x y", "New", "York", " ", "a-b", "\x1c"]
    sep = [" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b", "!?", " ;"]
    return [(rng.choice(["en", "de", None, ""]), "".join(rng.choice(vocabulary) + rng.choice(sep) for _ in range(rng.randrange(60)))) for _ in range(rows)]


@pytest.mark.parametrize("seed, support, words, shards, parts, top", [(1, 30, 4, 8, 3, 2000), (2, 4, 3, 16, 20, 7), (3, 5, 2, 1, 2, 2000), (4, 2, 4, 3, 9, 50)])
def test_brute_force(spark, seed, support, words, shards, parts, top):
    docs = made(seed, 1500 if support == 30 else 120)
    table = spark.createDataFrame(docs, "lang string, text string").repartition(parts)
    got = collocations(table, support, words, shards, top=top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute(docs, support, words, top=top)
    assert len(want) > 5 and sorted(map(tuple, got.collect())) == sorted(want)


def test_a_phrase_spread_thin_over_all_tasks(spark):
    """Once in each of 30 tasks: less than the local support in most places, frequent in all."""
    docs = [("en", f"word{i} rare pair word{i}x") for i in range(30)]
    frequent, _ = frequent_phrases(spark.createDataFrame(docs, "lang string, text string").repartition(30))
    assert sorted((r.phrase, r.n) for r in frequent.collect()) == [("pair", 30), ("rare", 30), ("rare pair", 30)]


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.execute(f"SELECT lang, rank, phrase, a, l, r, n, score FROM ({OP12_SQL})").fetchall()
    got = op12_collocations(spark, SF)
    assert {t for c, t in got.dtypes if c not in ("lang", "phrase")} == {"bigint"}
    assert len(want) > 10 and sorted(map(tuple, got.collect())) == sorted(want)


def test_products_beyond_64_bits(spark):
    big = 9 * 10**17
    frequent = spark.createDataFrame([("en", "a", big + 8), ("en", "b", big + 1), ("en", "a b", big)], "lang string, phrase string, n long")
    row = scored(frequent).collect()[0]
    assert (row.a, row.l, row.r, row.score) == (big, big + 8, big + 1, 2000000 * big // (2 * big + 9))


def test_odd_and_empty(spark, odd, none):
    assert collocations(none).count() == 0
    clash = odd.withColumns({"phrase": odd.node, "rank": odd.salt, "hash": odd.salt, "n": odd.salt, "key": odd.salt, "size": odd.salt, "part": odd.node})
    got = collocations(clash)
    assert sorted(map(tuple, got.collect())) == sorted(brute([(r.lang, r.text) for r in odd.collect()]))
    long = spark.createDataFrame([(1, "p q " * 300_000, None, "s", None, "n", "d", 1, 7, 0, "r", True, 3)], ODD)
    assert [(r.lang, r.phrase, r.a, r.n) for r in collocations(long).collect()] == [(lang, p, a, n) for lang, _, p, a, _, _, n, _ in brute([(None, "p q " * 300_000)])]


def test_what_workers_get_names_no_module_of_this_package(spark):
    import pickle

    from basketflow.llm import collocations as module

    words = spark.createDataFrame([("en", "a", 40), ("en", "b", 31)], "lang string, phrase string, n long")
    filters = [module.bitmap(module.hashed(words))]
    assert all(filters[0].passes(module.word_hashes(module.pa.array(["en", "en"]), module.pa.array(["a", "b"]))))
    assert b"basketflow" not in pickle.dumps(module._sent(words, filters).value)
