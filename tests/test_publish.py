"""Reruns, published results, observed metrics, mixed chunks and the one-scan pipeline on small folders."""

import datetime as dt
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from storetally.plans import pipeline
from storetally.plans.pipeline import daily_totals, run_pipeline
from storetally.sinks import published
from storetally.sinks.facts import save_partitioned
from storetally.sinks.results import observed, observed_metrics, run_metrics, save_result
from storetally.sources import parquet
from test_files import header_frame, star  # noqa: F401


def files(path):
    return {str(one): one.stat().st_mtime_ns for one in Path(path).rglob("part-*")}


def test_rerun_of_a_month_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "fact")
    fact = spark.createDataFrame([(y, m, i) for y in (1995, 1996) for m in (3, 4) for i in range(5)], "year int, month int, id int")
    save_partitioned(fact, path)
    before = files(path)
    save_partitioned(spark.createDataFrame([(1996, 4, 99)], "year int, month int, id int"), path, only_present=True)
    after = files(path)
    kept = {one: at for one, at in before.items() if "year=1996/month=4" not in one}
    assert len(kept) == 3 and kept.items() <= after.items()
    again = spark.read.parquet(path)
    assert [row["id"] for row in again.where("year = 1996 AND month = 4").collect()] == [99]
    assert again.count() == 16
    save_partitioned(fact.where("year = 1995"), path)
    assert spark.read.parquet(path).count() == 10


def test_rerun_of_a_result(spark, tmp_path):
    days = spark.createDataFrame([("a", 1), ("b", 2)], "day string, n int")
    path = save_result(days, str(tmp_path), "days", ["day"])
    save_result(days.where("day = 'b'").withColumn("n", F.lit(7)), str(tmp_path), "days", ["day"], only_present=True)
    assert sorted(map(tuple, spark.read.parquet(path).select("day", "n").collect())) == [("a", 1), ("b", 7)]
    with pytest.raises(ValueError):
        save_result(days, str(tmp_path), "days", ["day"], only_present=True, json_copy=True)


class Died(Exception):
    pass


def test_published_runs(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    numbers = spark.range(3)
    with pytest.raises(FileNotFoundError):
        published.load_latest(spark, path, "ids")
    assert published.publish({"ids": numbers, "more": numbers}, path, "run-1")
    # A run that dies after its results and before its manifest.
    with monkeypatch.context() as broken:
        broken.setattr(published, "json", type("json", (), {"dumps": lambda _: (_ for _ in ()).throw(Died()), "loads": published.json.loads}))
        with pytest.raises(Died):
            published.publish({"ids": spark.range(50)}, path, "run-2")
    assert (tmp_path / "_runs" / "run-2" / "ids").exists()
    assert published.load_latest(spark, path, "ids").count() == 3
    # Its repetition starts afresh; a published one is not repeated.
    assert published.publish({"ids": spark.range(5)}, path, "run-2")
    assert not published.publish({"ids": spark.range(70)}, path, "run-1")
    assert published.load_latest(spark, path, "ids").count() == 5
    assert published.load_latest(spark, path, "more").count() == 3
    assert published.load_all(spark, path, "ids").count() == 8
    assert [(one["run"], one["number"]) for one in published.manifests(spark, path)] == [("run-1", 1), ("run-2", 2)]
    for bad in ("", "../x", "a b"):
        with pytest.raises(ValueError):
            published.publish({"ids": numbers}, path, bad)


def test_metrics_need_no_job(spark, tmp_path):
    stats = spark.createDataFrame([(5, 7.25, None)], "total_transactions bigint, total_revenue double, unique_customers bigint")
    watched, watch = observed(stats)
    path = save_result(watched, str(tmp_path), "stats")
    spark.sparkContext.setJobGroup("metrics", "")
    found = observed_metrics(spark, watch)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("metrics")
    assert found.collect() == run_metrics(spark.read.parquet(path)).collect()


def test_mixed_chunks(spark, tmp_path):
    first, second, third = header_frame(0, 5), header_frame(5, 6), header_frame(11, 7)
    first.to_parquet(tmp_path / "transactions_chunk_0000.parquet", index=False)
    second.astype({"store_id": "int32", "month": "int8"}).to_parquet(tmp_path / "transactions_chunk_0001.parquet", index=False)
    third["timestamp"] = third["timestamp"].astype("datetime64[ns]")
    third["note"] = "x"
    third.to_parquet(tmp_path / "transactions_chunk_0002.parquet", index=False)
    found = parquet.load_mixed_chunks(spark, str(tmp_path))
    assert found.count() == 18 and found.where("note IS NOT NULL").count() == 7
    assert dict(found.dtypes)["store_id"] == "bigint" and dict(found.dtypes)["timestamp"] == "timestamp"
    expected = sorted(pd.concat([first, second, third])["timestamp"].dt.to_pydatetime())
    assert sorted(row["timestamp"].astimezone(dt.timezone.utc).replace(tzinfo=None) for row in found.select("timestamp").collect()) == expected
    with pytest.raises(FileNotFoundError):
        parquet.load_mixed_chunks(spark, str(tmp_path / "none"))


@pytest.mark.parametrize("window", ["1 month", "6 hours"])
def test_one_scan_gives_the_same(spark, star, tmp_path, window):  # noqa: F811
    paths = [str(tmp_path / name) for name in ("each", "once")]
    run_pipeline(spark, str(star), paths[0], window=window)
    run_pipeline(spark, str(star), paths[1], window=window, one_scan=True)
    for name in ("basic_stats", "customer_segments", "regional_analysis", "time_series"):
        each, once = (sorted(map(str, spark.read.parquet(f"{path}/{name}").collect())) for path in paths)
        assert each == once and each
    each, once = (sorted(map(tuple, spark.read.parquet(f"{path}/run_metrics").drop("ts").collect())) for path in paths)
    assert each == once and len(each) == 3


def test_totals_scan_the_fact_once(spark, star, tmp_path):  # noqa: F811
    fact = parquet.load_chunks(spark, str(star))
    totals, sums = daily_totals(fact, "1 month", str(tmp_path / "totals"))
    assert "transactions_chunk" not in totals._jdf.queryExecution().executedPlan().toString()
    assert sums.tallied and totals.agg(F.sum("row_count")).first()[0] == 80


def test_one_scan_reads_small_splits(spark, star, tmp_path, monkeypatch):  # noqa: F811
    """A task of the one-scan job takes few of the chunks, however few cores the cluster has."""
    sales = parquet.load_chunks(spark, str(star))
    for i in range(32):
        sales.coalesce(1).write.parquet(str(tmp_path / "many" / f"transactions_chunk_{i:04}.parquet"))
    for name in ("stores_master.parquet", "products_master.parquet"):
        (tmp_path / "many" / name).symlink_to(star / name)
    seen = []

    def totals(transactions, *others):
        seen.append(transactions.rdd.getNumPartitions())
        return daily_totals(transactions, *others)

    monkeypatch.setattr(pipeline, "daily_totals", totals)
    setting, cores = "spark.sql.files.maxPartitionBytes", "spark.sql.leafNodeDefaultParallelism"
    before = spark.conf.get(setting)
    spark.conf.set(cores, "1")
    try:
        for most in (before, "8m"):
            spark.conf.set(setting, most)
            run_pipeline(spark, str(tmp_path / "many"), str(tmp_path / "output"), one_scan=True)
            assert spark.conf.get(setting) == most
    finally:
        spark.conf.set(setting, before)
        spark.conf.unset(cores)
    # A file counts at least 4 MB.
    assert seen[0] >= 4 and seen[1] >= 16
