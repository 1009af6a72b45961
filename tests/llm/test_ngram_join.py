import random

import pytest
from pyspark.sql import functions as F

from basketflow.llm.common import words
from basketflow.llm.ngram_join import banding, components, gram_sets, keep_one, links, narrowed, ngram_join, signatures


def grams(text):
    found = words(text or "")
    n = min(5, len(found))
    return frozenset(tuple(found[i : i + n]) for i in range(len(found) - n + 1)) if n else frozenset()


def brute(rows, threshold=0.8):
    """(doc_id, class_id, n_links, n_copies) of every row."""
    sets = [grams(t) for _, t in rows]
    near = [[bool(a) and len(a & b) >= threshold * len(a | b) - 1e-9 for b in sets] for a in sets]
    out = []
    for i, (doc, _) in enumerate(rows):
        if not sets[i]:
            out.append((doc, doc, 0, 1))
            continue
        seen, todo = {i}, [i]
        while todo:
            k = todo.pop()
            for j, close in enumerate(near[k]):
                if close and j not in seen:
                    seen.add(j)
                    todo.append(j)
        copies = sum(s == sets[i] for s in sets)
        out.append((doc, min((rows[k][0] for k in seen if rows[k][0] is not None), default=None), sum(near[i]) - copies, copies))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "class_id", "n_links", "n_copies").collect()), key=str)


def test_documents(docs):
    assert rows_of(ngram_join(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("block", [1, 3, 256])
def test_chains_of_near_copies_over_blocks(spark, block):
    base = [f"w{i}" for i in range(60)]
    rows = [(k, " ".join(base[:k] + [f"new{j}" for j in range(k)] + base[2 * k :])) for k in range(12)]
    rows += [(100 + k, " ".join(f"v{k}_{i}" for i in range(20))) for k in range(5)] + [(50, rows[3][1]), (51, rows[3][1].upper())]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(ngram_join(df, block=block)) == brute(rows)


def test_odd_rows(odd):
    assert rows_of(ngram_join(odd)) == brute([(r.doc_id, r.text) for r in odd.collect()])


def test_no_rows(none):
    assert ngram_join(none).collect() == []


def test_banding_reaches_the_recall():
    bands, rows = banding(0.8, 0.9995)
    assert bands * rows <= 128 and rows > 3
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9995
    assert banding(1.0, 0.99)[0] == 1


def test_components(spark):
    edges = [("a", "b"), ("c", "b"), ("d", "c"), ("x", "y"), ("z", "y"), ("q", "q")] + [(f"n{i:03}", f"n{i + 1:03}") for i in range(40)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert found == dict.fromkeys("abcd", "a") | dict.fromkeys("xyz", "x") | {f"n{i:03}": "n000" for i in range(41)}


def test_links_name_their_partners(spark):
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(1, text), (2, text + " more")], "doc_id long, text string")
    signed = signatures(df, 5, 20, 5)
    members = signed.select("node", F.lit("c").alias("comp"), "doc_id", "text_key", F.lit(1).cast("long").alias("copies"))
    found = {r.node: r.linked for r in links(df, members, 5, 0.8, partners=True).collect()}
    assert len(found) == 2 and all(found[v[0]] == [k] for k, v in found.items())


def test_stage_keeps_one_of_each_class(spark, docs, odd):
    expected = {d for d, c, _, _ in brute([(r.doc_id, r.text) for r in docs.collect()]) if d == c}
    kept = keep_one(spark, docs, "")
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == expected
    assert keep_one(spark, odd, "").count() > 0


def test_stage_decides_per_row(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    near = a + " more"
    rows = [(3, a), (None, near), (None, b), (None, b), (4, c), (4, c), (4, near), (6, "-"), (7, "-"), (7, "-")]
    kept = keep_one(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(3, a), (None, b), (4, c), (6, "-"), (7, "-")], key=str)


def boilerplate(n):
    """Texts that share half of their words, in front: similar below the threshold, so that bands mix them."""
    common = " ".join(f"common{i}" for i in range(70))
    return [(i, common + " " + " ".join(f"own{i}x{j}" for j in range(40))) for i in range(n)]


def test_shared_boilerplate_is_not_compared(spark):
    """Texts of one component that share only boilerplate part before any pair is verified; links stay."""
    rows = boilerplate(400)
    rows += [(1000 + i, text + " tail") for i, (_, text) in enumerate(rows[:30])] + [(2000, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    bands, per_band = banding(0.8, 0.9995)
    nodes = signatures(df, 5, bands, per_band).dropDuplicates(["node"]).select("node", F.lit("all").alias("comp"), "doc_id", "text_key", F.lit(1).cast("long").alias("copies")).cache()
    held = gram_sets(df, nodes, 5)
    cut = narrowed(nodes.select("node", "comp", "copies"), held, 0.8, 32)
    sizes = [r["count"] for r in cut.groupBy("comp").count().collect()]
    assert sorted(sizes) == [2] * 30
    assert rows_of(ngram_join(df, block=32)) == brute(rows)


def test_prefix_filter_loses_no_link(spark):
    """Random sets of few grams around the threshold: every linked pair is still in one component."""
    rng = random.Random(4)
    rows = []
    for i in range(120):
        ws = [f"w{rng.randrange(4)}_{k}" if rng.random() < 0.015 else f"w_{k}" for k in range(rng.choice([40, 60, 62]))]
        rows.append((i, " ".join(ws)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    nodes = signatures(df, 5, 20, 5).dropDuplicates(["node"]).select("node", F.lit("all").alias("comp"), "doc_id", "text_key", F.lit(1).cast("long").alias("copies"))
    nodes = spark.createDataFrame(nodes.collect(), nodes.schema)
    held = gram_sets(df, nodes, 5)
    cut = {r.node: r.comp for r in narrowed(nodes.select("node", "comp", "copies"), held, 0.8, 4).collect()}
    text = dict(rows)
    named = [(r.node, grams(text[r.doc_id])) for r in nodes.collect()]
    linked = [(a, b) for a, x in named for b, y in named if a < b and len(x & y) >= 0.8 * len(x | y) - 1e-9]
    assert len(linked) > 20 and all(cut[a] == cut[b] for a, b in linked)


def test_repeated_rows_send_their_text_once_a_task(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(1, text)] * 300 + [(2, text + " more")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    nodes = signatures(df, 5, 20, 5).dropDuplicates(["node"]).select("node", F.lit("c").alias("comp"), "doc_id", "text_key", F.lit(1).cast("long").alias("copies"))
    assert gram_sets(df, nodes, 5).count() == 2
    assert {(r.doc_id, r.class_id, r.n_links, r.n_copies) for r in ngram_join(df).collect()} == {(1, 1, 1, 300), (2, 1, 300, 1)}
