from datetime import timedelta

import pytest
from conftest import day
from pyspark.sql import functions as F

from basketflow.config import IndexConfig
from basketflow.operators import price_index
from basketflow.operators.transform import keep_last
from basketflow.streaming import jobs

SCHEMA = "product_id STRING, category STRING, retailer STRING, price DOUBLE, timestamp TIMESTAMP_NTZ, event_id BIGINT"


@pytest.fixture
def folder(spark, tmp_path):
    """Two files of events: the second goes on in the same hours and days as the first."""

    def events(offset):
        return [
            (f"p{i % 4}", "grocery" if i % 2 else "housing", f"r{i % 3}", 5.0 + i % 7, day("2024-01-01") + timedelta(minutes=17 * i + offset), i * 10 + offset)
            for i in range(400)
        ]

    path = str(tmp_path / "in")
    add = lambda rows: spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    add(events(0))
    return path, lambda: add(events(5))


def test_hourly_last_equals_batch_over_micro_batches(spark, folder, tmp_path):
    path, more = folder
    out, marks = str(tmp_path / "out"), str(tmp_path / "marks")
    schema = spark.read.parquet(path).schema

    def work():
        last = jobs.hourly_last(["event_id"])
        kept = jobs.run_available(jobs.read_stream(spark, path, "*.parquet", schema, 1), last, out, marks)
        return jobs.merged(spark, out, kept, last)

    def batch():
        rows = spark.read.parquet(path).withColumn("hour_start", F.date_trunc("hour", "timestamp"))
        return keep_last(rows, jobs.HOUR_KEY, ["timestamp", "event_id"])

    ids = lambda df: sorted(r.event_id for r in df.select("event_id").collect())
    assert ids(work()) == ids(batch())
    more()
    assert ids(work()) == ids(batch())  # carries on from the checkpoint
    assert ids(work()) == ids(batch())  # nothing new


def test_category_index_equals_batch(spark, folder, tmp_path):
    path, more = folder
    out, marks = str(tmp_path / "out"), str(tmp_path / "marks")
    static = spark.read.parquet(path)
    base = price_index.base_prices(static, IndexConfig(base_period=day("2024-01-01"), base_days=2)).persist()
    seen = []

    def work():
        stream = jobs.read_stream(spark, path, "*.parquet", static.schema, 1)
        kept = jobs.run_available(stream, jobs.daily_relatives(base), out, marks, lambda df, i: seen.append(i))
        return jobs.sliding_index(jobs.merged(spark, out, kept, jobs.daily_sums), 3, 5)

    work()
    more()
    got = {(r.window_start, r.category): (r.n_rel, r.price_index) for r in work().collect()}
    assert len(set(seen)) >= 2
    rel = spark.read.parquet(path).join(base, ["category", "product_id"]).withColumn("ln", F.ln(F.col("price") / F.col("base_price")))
    rel = rel.withColumn("window_start", F.explode(F.sequence(F.date_sub(F.to_date("timestamp"), 2), F.to_date("timestamp"))))
    want = rel.groupBy("window_start", "category").agg(F.count("ln").alias("n"), F.avg("ln").alias("m")).collect()
    import math

    assert got.keys() == {(r.window_start, r.category) for r in want}
    for r in want:
        n, idx = got[r.window_start, r.category]
        assert n == r.n and idx == pytest.approx(math.exp(r.m) * 100 if r.n >= 5 else 100.0)


LATEST = "k STRING, v INT"


def latest(rows):
    return rows.groupBy("k").agg(F.max("v").alias("v"))


def test_replayed_batch_replaces_itself(spark, tmp_path):
    out = str(tmp_path / "out")
    write = jobs.batch_folder_sink(latest, out)
    df = spark.createDataFrame([("a", 1)], LATEST)
    write(df, 0)
    write(df, 0)
    write(df.withColumn("v", F.lit(2)), 1)
    assert [r.v for r in jobs.merged(spark, out, df.schema, latest).collect()] == [2]
    assert spark.read.parquet(f"{out}/batches").count() == 2


def test_unordered_batches_lose_no_row(spark, tmp_path):
    """Days come backwards, one file and so one batch each; state and folds equal the batch result."""
    path, out, marks = (str(tmp_path / x) for x in ("in", "out", "marks"))
    last = jobs.hourly_last(["event_id"])
    for k in (9, 2, 30, 1, 17):
        rows = [(f"p{i % 3}", "grocery", "r", 1.0 + i, day("2024-01-01") + timedelta(days=k - i % 2, minutes=i), k * 100 + i) for i in range(20)]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
        kept = jobs.run_available(jobs.read_stream(spark, path, "*.parquet", spark.read.parquet(path).schema, 1), last, out, marks)
        if k in (2, 1):
            jobs.compact(spark, out, kept, last)
    ids = lambda df: sorted(r.event_id for r in df.collect())
    assert ids(jobs.merged(spark, out, kept, last)) == ids(last(spark.read.parquet(path)))


def test_no_batch_yet(spark, tmp_path):
    schema = spark.createDataFrame([], LATEST).schema
    assert jobs.merged(spark, str(tmp_path / "none"), schema, latest).count() == 0
    jobs.compact(spark, str(tmp_path / "none"), schema, latest)


def folders(path):
    return sorted(str(p.relative_to(path)) for p in path.rglob("*=*") if list(p.glob("*.parquet")))


def test_folders_stay_few(spark, tmp_path):
    """Level by level: after n batches fewer than four folders a level, old ones gone, and the state is that of all batches."""
    path = tmp_path / "out"
    write = jobs.batch_folder_sink(latest, str(path), merge=latest)
    want = {}
    for i in range(40):
        batch = [(f"k{(i * 7) % 11}", 1000 - i), (f"k{i % 5}", i)]
        for k, v in batch:
            want[k] = max(v, want.get(k, v))
        df = spark.createDataFrame(batch, LATEST)
        write(df, i)
        if i % 9 == 0:
            write(df, i)  # replayed
        live = jobs._live(spark, str(path))
        levels = [level for _, level, _ in live]
        assert all(levels.count(level) < jobs.FAN for level in levels) and levels == sorted(levels, reverse=True)
        assert len(folders(path)) <= len(live) + 2 * jobs.FAN  # what the list before had may still be read
    assert [(last, level) for last, level, _ in live] == [(15, 2), (31, 2), (35, 1), (39, 1)]
    assert {r.k: r.v for r in jobs.merged(spark, str(path), df.schema, latest).collect()} == want
    jobs.compact(spark, str(path), df.schema, latest)
    assert len(jobs._live(spark, str(path))) == 1
    assert {r.k: r.v for r in jobs.merged(spark, str(path), df.schema, latest).collect()} == want


def test_what_no_list_names_is_not_read(spark, tmp_path):
    """A batch that died before its list was written leaves folders behind; they count only once it is repeated."""
    out = str(tmp_path / "out")
    write = jobs.batch_folder_sink(latest, out, merge=latest)
    df = spark.createDataFrame([("a", 1)], LATEST)
    write(df, 0)
    lost = spark.createDataFrame([("a", 7), ("b", 7)], LATEST)
    lost.write.parquet(f"{out}/batches/batch_id=1")
    lost.write.parquet(f"{out}/folded/level=1/until=1")
    assert [(r.k, r.v) for r in jobs.merged(spark, out, df.schema, latest).collect()] == [("a", 1)]
    write(lost, 1)
    assert sorted((r.k, r.v) for r in jobs.merged(spark, out, df.schema, latest).collect()) == [("a", 7), ("b", 7)]
