import glob
import json
import os
import time
from datetime import date, datetime

import pytest
from conftest import day
from pyspark.sql import functions as F

from basketflow.config import EtlConfig
from basketflow.operators import price_index
from basketflow.operators.quality import InvalidData
from basketflow.plans import etl
from basketflow.sources import storage

ROW = "product_id STRING, category STRING, retailer STRING, price DOUBLE, timestamp TIMESTAMP_NTZ, metadata MAP<STRING, STRING>"


def rows(spark, *days, category="grocery", price=1.0):
    return spark.createDataFrame([("p", category, "r", price, day(d), {"k": "v", "a": "b"}) for d in days], ROW)


def test_runs_snapshot_and_history(spark, tmp_path):
    path = str(tmp_path / "prices")
    assert storage.read_prices(spark, path) is None
    with pytest.raises(FileNotFoundError):
        storage.load_prices(spark, path)
    storage.write_prices(rows(spark, "2024-01-01", "2024-02-01", "2024-02-29").withColumn("run_id", F.lit("1")), path)
    storage.write_prices(rows(spark, "2024-02-01", "2024-03-01").withColumn("run_id", F.lit("2")), path)
    stored = storage.read_prices(spark, path)
    assert stored.count() == 5
    assert storage.latest_snapshot(spark, path).count() == 2 and storage.latest_snapshot(spark, str(tmp_path / "none")) is None
    assert "run_id=1" not in "".join(storage.latest_snapshot(spark, path).inputFiles())
    history = storage.history_scan(stored, datetime(2024, 1, 1), datetime(2024, 3, 1))
    assert history.count() == 4  # the row of 1 February is stored twice
    assert storage.history_scan(stored, datetime(2024, 1, 1), datetime(2024, 3, 1), "housing").count() == 0
    assert storage.load_prices(spark, path).count() == 5 and storage.load_prices(spark, path, latest_only=True).count() == 2
    plan = storage.history_scan(stored, datetime(2024, 2, 1), datetime(2024, 2, 15))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_unreadable_files_are_skipped(spark, tmp_path):
    path = str(tmp_path / "prices")
    storage.write_prices(rows(spark, "2024-01-01").withColumn("run_id", F.lit("1")), path)
    folder = f"{path}/run_id=2/month=2024-01"
    os.makedirs(folder)
    with open(f"{folder}/part-bad.parquet", "wb") as f:
        f.write(b"no parquet at all")
    assert storage.read_prices(spark, path).count() == 1


def test_raw_landing_skips_empty(spark, tmp_path):
    path = str(tmp_path / "raw")
    assert not storage.write_raw(rows(spark), path, "20240101_000000")
    assert storage.write_raw(rows(spark, "2024-01-01"), path, "20240101_000000") and spark.read.parquet(path).first().run_id == "20240101_000000"


def test_by_category(spark, tmp_path):
    path = str(tmp_path / "by")
    both = rows(spark, "2024-01-01").unionByName(rows(spark, "2024-01-01", category="housing")).withColumn("run_id", F.lit("1"))
    storage.write_by_category(both, path)
    assert {d for d in os.listdir(path) if d.startswith("category")} == {"category=grocery", "category=housing"}
    assert storage.read_prices(spark, path).where("category = 'housing'").count() == 1


def test_by_category_is_written_where_the_rows_are(spark, tmp_path):
    path = str(tmp_path / "by")
    dealt = rows(spark, *[f"2024-01-{d:02d}" for d in range(1, 31)]).withColumn("run_id", F.lit("1")).repartition(3)
    storage.write_by_category(dealt, path)
    assert len([f for f in os.listdir(f"{path}/category=grocery/run_id=1") if f.endswith(".parquet")]) == 3
    assert storage.read_prices(spark, path).count() == 30


def test_retention(spark, tmp_path):
    path = str(tmp_path / "prices")
    for run in ("1", "2", "3"):
        storage.write_prices(rows(spark, "2024-01-01", "2024-02-01").withColumn("run_id", F.lit(run)), path)
    old = datetime(2020, 1, 1).timestamp()
    for folder, _, files in os.walk(path):
        if "run_id=1" in folder or "run_id=3" in folder:
            for f in files:
                os.utime(os.path.join(folder, f), (old, old))
    sizes = [os.path.getsize(f) for f in glob.glob(f"{path}/run_id=1/*/*.parquet")]
    files = {r.status: (r.runs, r.files, r.bytes) for r in storage.retention_files(spark, path, "2").collect()}
    assert files["expired"] == (1, len(sizes), sum(sizes)) and files["kept"][0] == 2
    report = storage.drop_expired_runs(spark, path, datetime(2024, 6, 1), days=30)
    assert report["runs_deleted"] == 1 and report["files_deleted"] == 2 and report["bytes_freed"] > 0
    assert {r.run_id for r in spark.read.parquet(path).select("run_id").distinct().collect()} == {2, 3}  # the newest run stays
    dated = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 1, 2),), (date(2024, 1, 2),)], "date DATE")
    got = {r.status: (r.days, r.records) for r in storage.retention_report(dated, date(2024, 1, 2)).collect()}
    assert got == {"expired": (1, 1), "kept": (1, 2)}


def test_series_and_json(spark, tmp_path, observations):
    path = str(tmp_path / "s.csv")
    spark.createDataFrame([("a", date(2024, 1, 1), 1.5)], "series_id STRING, date DATE, value DOUBLE").write.csv(path, header=True)
    assert storage.read_series(spark, path).first() == ("a", date(2024, 1, 1), 1.5)
    cfg = price_index.IndexConfig(base_period=day("2024-01-01"), min_observations=1)
    panel = observations([("a", "grocery", "r", 10.0, day("2024-01-01")), ("a", "grocery", "r", 20.0, day("2025-01-01"))])
    out = str(tmp_path / "j")
    storage.write_json(price_index.index_at(panel, [day("2025-01-01")], cfg), out)
    text = "".join(open(os.path.join(out, f)).read() for f in os.listdir(out) if f.endswith(".json"))
    assert json.loads(text)["category_indices"]["grocery"] == pytest.approx(200.0)


FEED = "product_id STRING, product_name STRING, price STRING, category STRING, retailer STRING, url STRING, timestamp TIMESTAMP_NTZ"
NOW = datetime(2024, 1, 2, 6)


def feed(spark, n=30, retailer="Amazon", bad=2):
    t = day("2024-01-02T05:00:00")
    ok = [(f"p{i}", f" n{i} ", f"${10 + i % 3}", "Food", retailer, "https://x.com/1", t) for i in range(n)]
    broken = [("", "n", "1", "Food", retailer, "https://x.com/1", t)] * bad
    spike = [("spike", "n", "99999", "Food", retailer, "https://x.com/1", t)]
    return spark.createDataFrame(ok + broken + spike, FEED)


def config(tmp_path, **more):
    return EtlConfig(output_path=str(tmp_path / "out"), raw_path=str(tmp_path / "raw"), **more)


def test_run(spark, tmp_path):
    cfg = config(tmp_path)
    feeds = {"a": feed(spark), "w": feed(spark, 20, "Walmart", 0)}
    for _ in range(2):  # a repeated run replaces what it stored
        log = etl.run(spark, feeds, cfg, NOW).first()
        assert log.problems == []
        assert (log.landed, log.quarantined, log.transformed, log.outliers, log.stored) == (52, 2, 52, 2, 50)
        assert log.stored_share == pytest.approx(50 / 52) and log.seconds > 0
        stored = storage.read_prices(spark, f"{cfg.output_path}/prices")
        assert stored.count() == 50 and {r.category for r in stored.collect()} == {"grocery"}
        assert storage.read_prices(spark, f"{cfg.output_path}/by_category").count() == 50
    assert {r.product_name for r in stored.where("product_id = 'p0'").collect()} == {"n0"}
    kept = etl.landed(spark, f"{cfg.raw_path}/run_id=20240102_060000").where("not valid").collect()
    assert [(r.feed, r.reasons) for r in kept] == [("a", ["product_id"])] * 2


def test_run_with_nothing_and_without_validation(spark, tmp_path):
    empty = etl.run(spark, {"a": feed(spark).limit(0)}, config(tmp_path), NOW).first()
    assert (empty.landed, empty.stored_share, empty.problems) == (0, 0.0, [])
    assert etl.run(spark, {"a": feed(spark)}, config(tmp_path, validate=False), NOW).first().stored == 31


def test_run_policies(spark, tmp_path):
    strict = etl.QualityConfig(required_columns=("nope",))
    recorded = etl.run(spark, {"a": feed(spark)}, config(tmp_path), NOW, strict).first()
    assert recorded.problems == ["Missing required column: nope"] and recorded.stored == 30
    with pytest.raises(InvalidData):
        etl.run(spark, {"a": feed(spark)}, config(tmp_path / "x", on_invalid="raise"), NOW, strict)


def test_broken_feeds_are_noted(spark, tmp_path):
    corrupt = tmp_path / "corrupt"
    corrupt.mkdir()
    (corrupt / "part-0.parquet").write_bytes(b"no parquet at all")
    feeds = {
        "unfit": spark.range(3).select(F.array("id").alias("rating")),
        "corrupt": spark.read.schema(FEED).parquet(str(corrupt)),
        "good": feed(spark),
    }
    log = etl.run(spark, feeds, config(tmp_path), NOW).first()
    assert [p.split(":")[0] for p in log.problems] == ["feed unfit", "feed corrupt"] and log.stored == 30


def test_incremental_run(spark, tmp_path):
    late = feed(spark, 5, bad=0).withColumn("timestamp", F.expr("timestamp - INTERVAL 2 DAYS"))
    log = etl.run_incremental(spark, {"a": feed(spark), "old": late}, config(tmp_path), NOW, datetime(2024, 1, 1), ("food",)).first()
    assert log.landed == 31


def test_a_run_that_died_is_not_read(spark, tmp_path):
    """Some partitions of a newer run are there, its marker is not: readers keep to the older run, until the newer one is repeated."""
    for write, layout in ((storage.write_prices, "run_id={run}/month=2024-01"), (storage.write_by_category, "category=grocery/run_id={run}")):
        path = str(tmp_path / write.__name__)
        write(rows(spark, "2024-01-01", "2024-02-01").withColumn("run_id", F.lit("20240101_000000")), path)
        rows(spark, "2024-01-05").write.parquet(f"{path}/{layout.format(run='20240202_000000')}")
        assert [r.run_id for r in storage.latest_snapshot(spark, path).select("run_id").distinct().collect()] == ["20240101_000000"]
        assert storage.read_prices(spark, path).count() == 2
        write(rows(spark, "2024-01-05", "2024-02-05", "2024-03-05").withColumn("run_id", F.lit("20240202_000000")), path, runs=["20240202_000000"])
        assert storage.latest_snapshot(spark, path).count() == 3 and storage.read_prices(spark, path).count() == 5


def test_a_run_that_dies_while_it_is_replaced_is_withdrawn(spark, tmp_path):
    path = str(tmp_path / "prices")
    for run in ("1", "2"):
        storage.write_prices(rows(spark, "2024-01-01").withColumn("run_id", F.lit(run)), path)
    broken = rows(spark, "2024-02-01").withColumn("run_id", F.lit("2")).withColumn("price", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        storage.write_prices(broken, path, runs=["2"])
    assert storage.shown_runs(spark, path) == ["1"]
    assert [r.run_id for r in storage.latest_snapshot(spark, path).collect()] == [1]


def test_a_run_without_rows_is_shown_empty(spark, tmp_path):
    path = str(tmp_path / "prices")
    storage.write_prices(rows(spark).withColumn("run_id", F.lit("1")), path, runs=["1"])
    assert storage.shown_runs(spark, path) == ["1"] and storage.latest_snapshot(spark, path) is None


def shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (found.apply(i).getName() for i in range(found.size())) if name.startswith("shuffle_")}


def test_a_run_leaves_no_shuffle_files_and_no_settings(spark, tmp_path):
    names = [*etl.LITTLE_DISK, *etl.SIDE_BY_SIDE, "spark.sql.files.openCostInBytes"]
    before, held = shuffle_files(spark), [spark.conf.get(k, None) for k in names]
    assert etl.run(spark, {"a": feed(spark)}, config(tmp_path, validate=False), NOW).first().stored == 31
    until = time.monotonic() + 20
    while shuffle_files(spark) - before and time.monotonic() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert [spark.conf.get(k, None) for k in names] == held


def test_months_are_grouped_by_their_rows():
    assert storage.month_groups([(24001, 5), (24003, 5)], 40.0, 4) == [(24001, 1)]
    many = storage.month_groups([(m, 1_500_000) for m in range(100, 140)], 30.0, 4)
    assert len(many) == storage.PARTS and many[0][0] == 100 and sum(tasks for _, tasks in many) >= 60
    assert storage.month_groups([(7, 10_000_000)], 30.0, 4) == [(7, 10)]
    assert storage.month_groups([(7, 1_000_000)], 64 * (1 << 20) / 1_000_000, 1) == [(7, 2)]  # wide rows


@pytest.mark.parametrize("validate", [True, False])
def test_rows_of_many_months_are_stored_by_month_in_order(spark, tmp_path, monkeypatch, validate):
    monkeypatch.setattr(storage, "TASK_ROWS", 8)
    monkeypatch.setattr(storage, "LEAST_SHARE", 1.0)
    seen = feed(spark, 40, bad=0).withColumn("at", F.expr("IF(product_id = 'spike', 0, INT(SUBSTRING(product_id, 2)))"))
    seen = seen.withColumn("timestamp", F.expr("TIMESTAMP_NTZ '2023-11-05 03:00:00' + MAKE_DT_INTERVAL(at * 11 % 120, at % 5)")).drop("at")
    cfg = config(tmp_path, validate=validate)
    for _ in range(2):
        log = etl.run(spark, {"a": seen}, cfg, NOW).first()
        assert (log.problems, log.transformed, log.stored) == ([], 41, 41 - log.outliers) and log.outliers == int(validate)
    prices = f"{cfg.output_path}/prices/run_id=20240102_060000"
    assert len(os.listdir(prices)) >= 4
    for file in glob.glob(f"{prices}/*/*.parquet"):
        times = [r.timestamp for r in spark.read.parquet(file).collect()]
        assert times == sorted(times) and {f"month={t:%Y-%m}" for t in times} == {file.split("/")[-2]}
    by_month, by_category = (storage.read_prices(spark, f"{cfg.output_path}/{table}").drop("month", "run_id") for table in ("prices", "by_category"))
    assert sorted(map(str, by_month.select(sorted(by_month.columns)).collect())) == sorted(map(str, by_category.select(sorted(by_month.columns)).collect()))
    assert "part" not in by_month.columns and by_month.count() == log.stored
