import hashlib
import re

from pyspark.sql import functions as F

from basketflow.llm.exact_dedup import exact_dedup, keep_first


def brute(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault(re.sub("[\x20\x09-\x0d]+", " ", text or ""), []).append(i)
    out = []
    for body, ids in groups.items():
        least = min((i for i in ids if i is not None), default=None)
        out += [(i, least, len(ids), i == least, hashlib.sha256(body.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.digest) for r in df.collect()), key=str)


def test_documents(docs):
    assert rows_of(exact_dedup(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_odd_rows(odd):
    assert rows_of(exact_dedup(odd)) == brute([(r.doc_id, r.text) for r in odd.collect()])


def test_no_rows(none):
    assert exact_dedup(none).collect() == []


def test_contents_decide_when_digests_collide(odd):
    found = exact_dedup(odd, digest=lambda body: F.length(body).cast("string"), salts=2)
    expected = brute([(r.doc_id, r.text) for r in odd.collect()])
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in found.collect()), key=str) == sorted((x[:4] for x in expected), key=str)


def test_many_copies_over_salts(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same  text").otherwise(F.col("id").cast("string")).alias("text"))
    found = exact_dedup(rows).filter("group_size > 1").groupBy("keep_id", "group_size").count().collect()
    assert [tuple(r) for r in found] == [(0, 1000, 1000)]


def test_stage_keeps_columns(spark, docs, odd):
    kept = keep_first(spark, docs, "")
    assert kept.columns == docs.columns
    assert kept.count() == len({re.sub("[\x20\x09-\x0d]+", " ", r.text or "") for r in docs.collect()})
    assert {r.doc_id for r in keep_first(spark, odd, "").collect()} == {1, 2, 3, 5, 7, 8, 9, None}


def test_stage_decides_per_row(spark):
    rows = [(3, "same"), (None, "same"), (None, "other"), (None, "other"), (4, "third"), (4, "third"), (4, "same"), (2, "fourth"), (5, "fourth"), (5, "fifth")]
    kept = keep_first(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(3, "same"), (None, "other"), (4, "third"), (2, "fourth"), (5, "fifth")], key=str)
