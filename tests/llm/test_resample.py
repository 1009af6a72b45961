import math

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF
from pyspark.sql import functions as F

from basketflow.llm.resample import block_slots, cut_between, keep_sampled, kth_largest, labelled, log_weight, quality_sample, ratio_table

LABELS = "doc_id long, quality int, toxic int"


def test_parts_good_from_bad(spark):
    docs, labels = (spark.read.parquet(f"{SF.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    found = quality_sample(docs, labels).join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    kept = {r.quality: r.kept for r in found}
    assert kept[1] > 0.95 and kept[0] < 0.2


def test_parts_good_from_bad_on_labels_it_has_not_seen(spark):
    docs, labels = (spark.read.parquet(f"{SF.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    unseen = F.pmod(F.xxhash64("doc_id", F.lit("unseen")), F.lit(2)) == 1
    found = quality_sample(docs, labels.filter(~unseen)).join(labels.filter(unseen), "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    share = {r.quality: r.kept for r in found}
    assert share[1] > 0.95 and share[0] < 0.1, share


def test_table_is_the_ratio_of_counts(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    sample = labelled(labels)
    good = {r.doc_id for r in sample.collect() if r.half == 0 and r.quality == 1}
    counts = np.zeros((2, 256))
    for r in docs.collect():
        found = np.bincount(block_slots(pa.array([r.text]), 8)[0], minlength=256)
        counts[0] += found
        counts[1] += found * (r.doc_id in good)
    raw = (counts[0] + 0.5) / (counts[0] + 0.5).sum()
    expected = np.log((counts[1] + 256 * raw) / (counts[1].sum() + 256) / raw)
    assert np.allclose(ratio_table(docs, sample, 8), expected)


@pytest.mark.parametrize("k", [1, 2, 500, 5000, 9999])
def test_kth_largest(spark, k):
    df = spark.range(10_000).select((F.floor(F.col("id") / 3) * 1.5 - (F.col("id") == 0).cast("int") * 1e6).alias("x"))
    values = sorted((r.x for r in df.collect()), reverse=True)
    assert kth_largest(df, "x", k) == values[k - 1]


def test_kth_largest_at_the_ends(spark):
    df = spark.range(5).select(F.lit(2.0).alias("x"))
    assert (kth_largest(df, "x", 0), kth_largest(df, "x", 5), kth_largest(df, "x", 3)) == (math.inf, -math.inf, 2.0)


def test_cut():
    assert cut_between([3.0, 4.0, 5.0], [1.0, 2.0]) == 2.5
    assert cut_between([], [1.0]) == -math.inf == cut_between([1.0], [])


def test_sample_is_bounded(spark):
    rows = spark.range(100).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"), F.lit(0).alias("toxic"))
    assert labelled(rows, 10).groupBy("quality").count().filter("count <> 10").count() == 0


def test_odd_rows_and_labels(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, 0), (7, 0, 1), (7, 1, 0), (8, 0, 0), (None, 1, 0), (3, None, None), (9, 1, 0)], LABELS)
    found = quality_sample(odd, labels).collect()
    assert len(found) == odd.count()
    assert len({(r.log_weight, r.kept) for r in found if r.doc_id == 8}) == 1
    assert {r.log_weight for r in found if r.doc_id in (3, 4, 5)} == {0.0}
    assert quality_sample(none, labels).collect() == []
    unlabelled = quality_sample(odd, spark.createDataFrame([], LABELS)).collect()
    assert all(r.kept and r.log_weight == 0 for r in unlabelled)


def test_stage_agrees_with_the_operator(spark, docs):
    kept = keep_sampled(spark, docs, SF)
    expected = {r.doc_id for r in quality_sample(docs, spark.read.parquet(f"{SF}/labels.parquet")).filter("kept").collect()}
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == expected


def test_slots_of_a_text_do_not_depend_on_its_neighbours():
    texts = ["", "One  two two THREE!!", " \n ", "x", "\u3000a b c a b c", "b", "a b"]
    found, owner = block_slots(pa.array(texts), 16)
    for i, text in enumerate(texts):
        assert block_slots(pa.array([text]), 16)[0].tolist() == found[owner == i].tolist()
        n = len(text.split())
        assert (owner == i).sum() == n + sum(max(0, n - k) for k in range(3))


def test_weight_sums_the_table(spark, docs):
    table = np.linspace(-1, 1, 256)
    for r in docs.limit(20).select("text", log_weight(table)("text").alias("w")).collect():
        assert abs(r.w - table[block_slots(pa.array([r.text]), 8)[0]].sum()) < 1e-6
