"""Stages and the whole pipeline on odd rows and on columns whose names the code might use itself."""

import re
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from basketflow.llm.common import words
from basketflow.llm.exact_dedup import keep_first
from basketflow.llm.ngram_join import keep_one
from basketflow.llm.packing import packed
from basketflow.llm.resample import keep_sampled, quality_sample

from .conftest import ODD, SF

corpus_pipeline = pytest.importorskip("corpus_pipeline")
CLASH = ["_id", "_key", "_nil", "_gumbel_key", "id", "KEY", "no_id", "kept_", "class_id", "keep_id", "rep", "log_weight", "text_key", "piece", "sequence_id"]


def clashing(docs, value):
    return docs.withColumns({c: value for c in CLASH if c.lower() not in {x.lower() for x in docs.columns}})


def grams(text):
    found = words(text or "")
    return {tuple(found[i : i + 5]) for i in range(len(found) - 4)} or ({tuple(found)} if found else set())


def first_key(row):
    return (row[0] is None, row[0] or 0)


def exact(rows):
    """One row of every text equal up to white space, of the least id."""
    best = {}
    for row in sorted(rows, key=first_key):
        best.setdefault(re.sub("[\x20\x09-\x0d]+", " ", row[1] or ""), row)
    return list(best.values())


def near(rows):
    """One row of every class of linked texts, of the least id; the stage before left no two rows of a text and id."""
    sets = [grams(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    best = {}
    for i, row in sorted(enumerate(rows), key=lambda r: first_key(r[1])):
        best.setdefault(find(i) if sets[i] else ("alone", row[0], row[1]), row)
    return list(best.values())


@pytest.fixture(scope="module")
def mixed(spark, docs, odd):
    """Odd rows, near copies of them and some documents."""
    base = " ".join(f"w{i}" for i in range(300))
    copies = [(40, base), (41, base.replace("w7 ", "x ")), (42, base + " more"), (None, base + "  more"), (44, "w1 w2 w3"), (None, "w1 w2 w3"), (45, "w1 w2 w3")]
    more = spark.createDataFrame([(i, t, None, "s", None, "n", "d", 1, 7, 0, "r", True, 3) for i, t in copies], ODD)
    return odd.unionByName(more).unionByName(docs.limit(60).select("doc_id", "text"), allowMissingColumns=True)


@pytest.mark.parametrize("value", ["int", "string"])
def test_stages_ignore_what_other_columns_are_called(spark, mixed, value):
    docs = clashing(mixed, (F.lit(3) if value == "int" else F.lit("x")))
    rows = [(r.doc_id, r.text) for r in mixed.collect()]
    for stage, brute in ((keep_first, exact), (keep_one, near)):
        got = stage(spark, docs, SF)
        assert got.columns == docs.columns
        source = rows if brute is exact else exact(rows)
        table = docs if brute is exact else keep_first(spark, docs, SF)
        kept = [(r.doc_id, r.text) for r in stage(spark, table, SF).collect()]
        norm = lambda t: re.sub("[\x20\x09-\x0d]+", " ", t or "")  # noqa: E731  (of equal texts any spelling stays)
        assert Counter((i, norm(t)) for i, t in kept) == Counter((i, norm(t)) for i, t in brute(source))
    sampled = keep_sampled(spark, docs, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    expected = quality_sample(mixed, labels).filter("kept").groupBy("doc_id").count()
    assert sampled.columns == docs.columns
    assert {r.doc_id: r["count"] for r in sampled.groupBy("doc_id").count().collect()} == {r.doc_id: r["count"] for r in expected.collect()}
    assert packed(spark, docs, SF).select("doc_id").distinct().count() == len({i for i, _ in rows})


def test_whole_run_equals_its_stages_by_brute_force(spark, mixed, tmp_path):
    docs = clashing(mixed, F.lit(3))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    kept = [(r.doc_id, r.text) for r in keep_sampled(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path)).collect()]
    assert 60 < len(kept) <= mixed.count()
    left = near(exact(kept))
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokens = Counter()
    for i, text in left:
        tokens[i] += len(library.encode(text or "", add_special_tokens=False).ids) + 1
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    found = Counter()
    for r in got:
        found[r.doc_id] += r.length
    assert found == tokens
    held = {}
    for r in got:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_whole_run_on_no_rows(spark, none, tmp_path):
    clashing(none, F.lit(3)).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
