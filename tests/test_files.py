"""Sources, sinks and jobs on folders."""

import datetime as dt
import json
import subprocess
import sys
from pathlib import Path
from types import SimpleNamespace

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from fixtures import rows
from storetally.plans.pipeline import build_flat, run_flat, run_pipeline
from storetally.session import run_folder, shared_base
from storetally.sinks.facts import save_bucketed, save_chunks, save_clustered, save_partitioned
from storetally.sinks.results import run_metrics, save_result
from storetally.sources import parquet

REPO = Path(__file__).parent.parent


def header_frame(first_id, count):
    stamps = [dt.datetime(2024, 1 + i % 3, 10, 9, i % 60) for i in range(count)]
    return pd.DataFrame(
        {
            "transaction_id": range(first_id, first_id + count),
            "store_id": [1 + i % 3 for i in range(count)],
            "customer_id": [f"COM_{i % 7:08d}" for i in range(count)],
            "customer_segment": ["Commercial" if i % 7 else "DIY Homeowner" for i in range(count)],
            "timestamp": pd.Series(stamps).astype("datetime64[us]"),
            "date": [stamp.date() for stamp in stamps],
            "month": [stamp.month for stamp in stamps],
            "year": [stamp.year for stamp in stamps],
            "total_amount": [round(1.25 * (i % 11), 2) for i in range(count)],
        }
    )


@pytest.fixture(scope="module")
def star(tmp_path_factory):
    """Two fact files, one deeper, with item, store and product files beside them."""
    folder = tmp_path_factory.mktemp("star")
    header_frame(0, 50).to_parquet(folder / "transactions_chunk_0000.parquet", index=False)
    header_frame(50, 30).to_parquet(folder / "transactions_chunk_0001.parquet", index=False)
    pd.DataFrame(
        {
            "transaction_id": [i // 2 for i in range(160)],
            "item_sequence": [1 + i % 2 for i in range(160)],
            "sku": [f"P{i % 4}" for i in range(160)],
            "quantity": [1 + i % 5 for i in range(160)],
            "unit_price": [2.5] * 160,
            "line_total": [2.5 * (1 + i % 5) for i in range(160)],
            "discount_amount": [0.0] * 160,
        }
    ).to_parquet(folder / "transaction_items_chunk_0000.parquet", index=False)
    pd.DataFrame({"store_id": [1, 2], "region": ["West", "West"], "state": ["CA", "NV"]}).to_parquet(
        folder / "stores_master.parquet", index=False
    )
    pd.DataFrame({"sku": ["P0", "P1", "P2"], "category": ["Primers", "Primers", "Tools"]}).to_parquet(
        folder / "products_master.parquet", index=False
    )
    return folder


def test_loaders_read_fact_files_only(spark, star):
    for load in (parquet.load_chunks, parquet.load_filtered, parquet.load_recursive):
        assert load(spark, str(star)).count() == 80
    assert parquet.load_chunks(spark, str(star), "items").count() == 160
    assert parquet.load_stores(spark, str(star)).count() == 2


def test_recursive_loader_goes_deeper(spark, star, tmp_path):
    (tmp_path / "2024" / "01").mkdir(parents=True)
    header_frame(0, 5).to_parquet(tmp_path / "2024" / "01" / "transactions_chunk_0000.parquet", index=False)
    header_frame(5, 6).to_parquet(tmp_path / "2024" / "transactions_chunk_0001.parquet", index=False)
    pd.DataFrame({"other": [1]}).to_parquet(tmp_path / "2024" / "stores_master.parquet")
    assert parquet.load_recursive(spark, str(tmp_path)).count() == 11


def test_nanosecond_timestamps(spark, tmp_path):
    frame = header_frame(0, 3)
    frame["timestamp"] = pd.to_datetime(["2024-01-01 00:00:00.123456789", "1969-12-31 23:59:59.999999", None])
    table = pa.Table.from_pandas(frame, preserve_index=False)
    assert table.schema.field("timestamp").type == pa.timestamp("ns")
    pq.write_table(table, tmp_path / "transactions_chunk_0000.parquet")
    loaded = parquet.load_chunks(spark, str(tmp_path)).orderBy("transaction_id")
    found = [row[0] for row in loaded.select(F.col("timestamp").cast("string")).collect()]
    assert found[0] == "2024-01-01 00:00:00.123456" and found[2] is None
    assert found[1] == "1969-12-31 23:59:59.999999"


def test_schema_check(spark, tmp_path):
    frame = header_frame(0, 3)
    frame.drop(columns="total_amount").to_parquet(tmp_path / "transactions_chunk_0000.parquet", index=False)
    with pytest.raises(parquet.SchemaMismatch, match="total_amount"):
        parquet.load_chunks(spark, str(tmp_path))
    wrong = spark.createDataFrame([("a", "West", "CA")], "store_id string, region string, state string")
    with pytest.raises(parquet.SchemaMismatch, match="store_id"):
        parquet.conform(wrong, "stores")
    narrow = spark.createDataFrame([(1, "West", "CA", 5)], "store_id int, region string, state string, extra int")
    assert dict(parquet.conform(narrow, "stores").dtypes) == {
        "store_id": "bigint",
        "region": "string",
        "state": "string",
        "extra": "int",
    }


def test_unique_check(spark):
    assert parquet.check_unique(spark.range(5), "id") == 5
    with pytest.raises(ValueError, match="not unique"):
        parquet.check_unique(spark.range(5).union(spark.range(1)), "id")


def test_keep_caches_chosen_columns(spark, star):
    kept = parquet.keep(parquet.load_chunks(spark, str(star)), ["store_id", "total_amount"])
    assert kept.is_cached and kept.columns == ["store_id", "total_amount"] and kept.count() == 80
    kept.unpersist()


def part_files(folder):
    return sorted(Path(folder).rglob("part-*"))


def test_result_is_one_snappy_file_in_order(spark, tmp_path):
    result = spark.range(500).selectExpr("id % 50 AS k").groupBy("k").count().orderBy(F.desc("k"))
    path = save_result(result, str(tmp_path), "numbers")
    assert path == f"{tmp_path}/numbers"
    (file,) = part_files(path)
    assert file.name.endswith(".snappy.parquet")
    assert [row[0] for row in spark.read.parquet(path).collect()] == list(range(49, -1, -1))
    save_result(result, str(tmp_path), "numbers")
    assert spark.read.parquet(path).count() == 50
    save_result(result, str(tmp_path), "numbers", mode="append")
    assert spark.read.parquet(path).count() == 100


def test_json_copy_belongs_to_its_result(spark, tmp_path):
    summary = tmp_path / "ids_summary.json"
    result = spark.range(5000).selectExpr("id", "nullif(id, 3) AS other")
    save_result(result, str(tmp_path), "ids", json_copy=True)
    assert spark.read.json(str(summary)).count() == 5000
    texts = [json.loads(line) for file in summary.glob("part-*") for line in file.read_text().splitlines()]
    assert {"id": 3, "other": None} in texts
    save_result(result.limit(5), str(tmp_path), "ids", json_copy=True)
    assert spark.read.json(str(summary)).count() == 5
    save_result(result, str(tmp_path), "ids")
    assert not summary.exists()
    with pytest.raises(ValueError):
        save_result(result, str(tmp_path), "ids", mode="append", json_copy=True)


def test_one_file_on_demand(spark, tmp_path):
    many = spark.range(0, 100, 1, 4)
    assert len(part_files(save_result(many, str(tmp_path), "a"))) == 4
    assert len(part_files(save_result(many, str(tmp_path), "b", one_file=True))) == 1


def test_result_by_partition(spark, tmp_path):
    result = spark.sql("SELECT id, date_add(date'2024-01-01', cast(id AS int)) AS day FROM range(3)")
    path = save_result(result, str(tmp_path), "days", ["day"])
    assert sorted(p.name for p in Path(path).glob("day=*")) == ["day=2024-01-01", "day=2024-01-02", "day=2024-01-03"]


def test_chunks_hold_a_bounded_number_of_rows(spark, tmp_path):
    path = save_chunks(spark.range(0, 250, 1, 1), str(tmp_path), rows=100)
    assert sorted(pq.ParquetFile(p).metadata.num_rows for p in part_files(path)) == [50, 100, 100]


def test_partitioned_fact_is_pruned(spark, star, tmp_path):
    fact = parquet.load_chunks(spark, str(star))
    save_partitioned(fact, str(tmp_path / "fact"))
    assert len(part_files(tmp_path / "fact")) == 3
    loaded = parquet.load_partitioned(spark, str(tmp_path / "fact"))
    february = loaded.where((F.col("year") == 2024) & (F.col("month") == 2))
    assert february.count() == fact.where(F.col("month") == 2).count()
    plan = february._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_metrics(spark):
    stats = spark.sql("SELECT 3L AS total_transactions, 1.5D AS total_revenue, 2L AS unique_customers")
    assert [tuple(row.values()) for row in rows(run_metrics(stats))] == [
        ("TransactionsLoaded", 3.0, "Count"),
        ("TotalRevenue", 1.5, "Count"),
        ("UniqueCustomers", 2.0, "Count"),
    ]


def test_pipeline(spark, star, tmp_path):
    summary = run_pipeline(spark, str(star), str(tmp_path))
    assert summary["transaction_count"] == 80
    assert summary["master_data"] == {"stores_count": 2, "products_count": 3}
    assert summary["basic_statistics"]["active_stores"] == 3
    assert set(summary["analysis_results"]) == {
        "basic_stats",
        "customer_segments",
        "regional_analysis",
        "time_series",
    }
    for path in summary["analysis_results"].values():
        assert spark.read.parquet(path).count() > 0
    written = json.loads(part_files(tmp_path / "analysis_summary.json")[0].read_text())
    assert written["basic_statistics"]["date_from"] == "2024-01-10"
    regions = {(row["region"], row["state"]) for row in rows(spark.read.parquet(str(tmp_path / "regional_analysis")))}
    assert regions == {("West", "CA"), ("West", "NV"), (None, None)}
    metrics = spark.read.parquet(str(tmp_path / "run_metrics"))
    assert metrics.columns == ["metric", "value", "unit", "ts"] and metrics.count() == 3
    for layout in ("filtered", "recursive"):
        again = run_pipeline(spark, str(star), str(tmp_path / layout), layout, cache=layout == "filtered")
        assert again["basic_statistics"] == summary["basic_statistics"]


def test_pipeline_refuses_repeated_stores(spark, star, tmp_path):
    header_frame(0, 5).to_parquet(tmp_path / "transactions_chunk_0000.parquet", index=False)
    pd.DataFrame({"store_id": [1, 1], "region": ["A", "B"], "state": ["A", "B"]}).to_parquet(
        tmp_path / "stores_master.parquet"
    )
    with pytest.raises(ValueError, match="not unique"):
        run_pipeline(spark, str(tmp_path), str(tmp_path / "out"))


def test_flat_jobs(spark, star, tmp_path):
    build_flat(spark, str(star), str(tmp_path / "flat"))
    paths = run_flat(spark, str(tmp_path / "flat"), str(tmp_path / "out"))
    assert len(paths) == 6
    (stats,) = rows(spark.read.parquet(paths["basic_stats"]))
    assert stats["total_transactions"] == 160
    categories = rows(spark.read.parquet(paths["product_performance"]))
    assert {row["product_category"] for row in categories} == {"Primers", "Tools", None}
    assert sum(row["total_revenue"] for row in categories) == stats["total_revenue"]


def test_run_folders_are_new_and_shared(spark):
    first, second = run_folder(spark, "x"), run_folder(spark, "x")
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_command_line(star, tmp_path):
    done = subprocess.run(
        [sys.executable, "-m", "storetally", "--input-path", str(star), "--output-path", str(tmp_path)],
        cwd=REPO,
        capture_output=True,
        text=True,
        timeout=300,
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert json.loads(done.stdout)["transaction_count"] == 80


def test_buckets_hold_what_was_written_last(spark, tmp_path):
    path = str(tmp_path / "it's a fact")
    first = spark.createDataFrame([(None, 1.0), (1, 2.0), (1, None)], "key long, `an amount` double")
    for fact in (spark.range(50).selectExpr("id AS key", "1D AS `an amount`"), first):
        save_bucketed(fact, path, "key", 4)
    found = parquet.load_bucketed(spark, path, "key", 4)
    assert sorted(map(str, found.collect())) == sorted(map(str, first.collect()))
    assert found.schema.names == ["key", "an amount"]
    assert not [one for one in spark.catalog.listTables() if one.name.startswith("storetally_")]
    save_bucketed(first.limit(0), path, "key", 4)
    empty = parquet.load_bucketed(spark, path, "key", 4)
    assert empty.count() == 0 and empty.schema.names == ["key", "an amount"]


def test_uneven_buckets_are_read_as_files(spark, tmp_path):
    """A hot key is left to the shuffles, which can be split; the rows are the same."""
    threshold = "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"
    before = spark.conf.get(threshold)
    keys = "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS key"
    path = save_bucketed(spark.range(30_000).selectExpr(keys, "rand(1) AS amount"), str(tmp_path / "hot"), "key", 32)
    sizes = parquet.bucket_bytes(spark, path)
    assert len(sizes) == 32 and max(sizes.values()) > 5 * sorted(sizes.values())[16]
    try:
        for limit, bucketed in (("1GB", True), ("1KB", False)):
            spark.conf.set(threshold, limit)
            found = parquet.load_bucketed(spark, path, "key", 32)
            plan = found.groupBy("key").count()._jdf.queryExecution().executedPlan().toString()
            assert ("hashpartitioning(key" not in plan) == bucketed
            assert found.where("key = 0").count() == 10_000
    finally:
        spark.conf.set(threshold, before)


def test_clustered_files_are_bounded_and_replaced(spark, tmp_path):
    path = str(tmp_path / "clustered")
    hot = spark.range(5_000).selectExpr("DATE'2024-01-01' AS date", "id", "CAST(NULL AS STRING) AS customer_id")
    for fact in (spark.range(7).selectExpr("current_date() AS date", "id", "'a' AS customer_id"), hot):
        save_clustered(fact, path, ["date", "id"], ["customer_id"], rows=300)
    files = list(Path(path).glob("part-*.parquet"))
    assert sum(pq.read_metadata(one).num_rows for one in files) == 5_000
    assert max(pq.read_metadata(one).num_rows for one in files) <= 300
    save_clustered(hot.limit(0), path, ["date", "id"], ["customer_id"])
    assert spark.read.parquet(path).count() == 0


def test_local_warehouse_of_a_cluster_is_refused(spark, tmp_path):
    def session(master, **conf):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda name, default=None: conf.get(name.split(".")[1], default)),
            sparkContext=SimpleNamespace(master=master),
            _jvm=spark._jvm,
            _jsc=spark._jsc,
        )

    assert shared_base(session("local[8]", sql=str(tmp_path))) == f"{tmp_path}/_runs"
    assert shared_base(session("spark://host:7077", sql=str(tmp_path), checkpoint="/shared/")) == "/shared"
    with pytest.raises(RuntimeError, match="checkpoint.dir"):
        shared_base(session("spark://host:7077", sql=str(tmp_path)))
