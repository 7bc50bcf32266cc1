"""Sinks for results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from storetally.session import remove_folder

# Names of the metrics and where they come from.
METRICS = {
    "TransactionsLoaded": "total_transactions",
    "TotalRevenue": "total_revenue",
    "UniqueCustomers": "unique_customers",
}


def save_result(
    result: DataFrame,
    path: str,
    name: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    one_file: bool = False,
    json_copy: bool = False,
    only_present: bool = False,
) -> str:
    """Snappy Parquet at `<path>/<name>`; returns that path. The query runs once.

    `one_file` writes a single file, for results known to be small.
    `json_copy` adds `<name>_summary.json` with every column, NULL too, read from
    what was written. Without it, a copy of an earlier result is removed. A copy
    belongs to one written result, so it does not go with `mode="append"`.
    `only_present` replaces only the partitions that `result` has rows for.
    """
    if json_copy and (mode == "append" or only_present):
        raise ValueError("a JSON copy shows one result, not all that were written to its folder")
    target = f"{path.rstrip('/')}/{name}"
    writer = (result.coalesce(1) if one_file else result).write.mode(mode).option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option(
            "partitionOverwriteMode", "dynamic" if only_present else "static"
        )
    copy = f"{target}_summary.json"
    remove_folder(result.sparkSession, copy)
    writer.parquet(target)
    if json_copy:
        # The declared schema keeps the types of partition columns.
        written = result.sparkSession.read.schema(result.schema).parquet(target)
        written.coalesce(1).write.option("ignoreNullFields", "false").json(copy)
    return target


def observed(stats: DataFrame) -> tuple[DataFrame, Observation]:
    """Headline statistics whose metrics are taken while they are written, by the same job."""
    watch = Observation()
    return stats.observe(watch, *[F.max(column).alias(column) for column in METRICS.values()]), watch


def observed_metrics(spark: SparkSession, watch: Observation) -> DataFrame:
    """`run_metrics` of observed statistics; waits for the job that writes them, and runs none."""
    values = watch.get
    rows = [(metric, None if values[column] is None else float(values[column]), "Count") for metric, column in METRICS.items()]
    return spark.createDataFrame(rows, "metric string, value double, unit string").coalesce(1)


def run_metrics(stats: DataFrame) -> DataFrame:
    """Headline statistics as (metric, value, unit) rows."""
    metrics = [
        F.struct(
            F.lit(metric).alias("metric"),
            F.col(column).cast("double").alias("value"),
            F.lit("Count").alias("unit"),
        )
        for metric, column in METRICS.items()
    ]
    return stats.select(F.inline(F.array(*metrics)))
