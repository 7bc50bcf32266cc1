"""Sinks for fact tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from storetally.sources.parquet import bucket_bytes

# Fixed value: rows of a chunk file.
CHUNK_ROWS = 1_000_000


def save_chunks(fact: DataFrame, path: str, name: str = "transactions_chunk_0000", rows: int = CHUNK_ROWS) -> str:
    """Snappy Parquet folder whose files hold at most `rows` rows; `load_chunks` finds it."""
    target = f"{path.rstrip('/')}/{name}.parquet"
    fact.write.mode("overwrite").option("compression", "snappy").option("maxRecordsPerFile", rows).parquet(target)
    return target


def save_partitioned(
    fact: DataFrame, path: str, by: Sequence[str] = ("year", "month"), only_present: bool = False
) -> str:
    """Snappy Parquet partitioned by calendar columns; replaces what is at `path`.

    With `only_present` only the partitions that `fact` has rows for are replaced, for the rerun of a
    month; the files of all others stay untouched.

    `rebalance` brings the rows of a partition together, so tasks do not each
    write a small file to every folder, and AQE splits a partition that grows
    beyond the advisory size, so a hot month is written by many tasks.
    """
    mode = "dynamic" if only_present else "static"
    writer = fact.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", mode)
    writer.option("compression", "snappy").partitionBy(*by).parquet(path)
    return path


def save_bucketed(fact: DataFrame, path: str, by: str, buckets: int) -> str:
    """Snappy Parquet in `buckets` files by the hash of `by`; replaces what is at `path`.

    This is the one shuffle of the fact; joins and groups on `by` of what `load_bucketed` reads
    need none. Rows with a NULL key share a bucket. Without rows one empty file keeps the columns.
    """
    spark = fact.sparkSession
    name = f"storetally_{uuid.uuid4().hex}"
    rows = fact.repartition(buckets, by)
    try:
        rows.write.mode("overwrite").option("compression", "snappy").option("path", path).bucketBy(buckets, by).saveAsTable(
            name
        )
    finally:
        # The folder stays: it is not the catalog's.
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    if not bucket_bytes(spark, path):
        fact.limit(0).write.mode("overwrite").parquet(path)
    return path


def save_clustered(
    fact: DataFrame,
    path: str,
    by: Sequence[str],
    points: Sequence[str] = (),
    rows: int = CHUNK_ROWS,
    distinct: int | None = None,
) -> str:
    """Snappy Parquet whose files hold ranges of `by`, each at most `rows` rows; replaces what is at `path`.

    A filter on the first column of `by` skips row groups by their least and greatest values, if Spark pushes
    filters on its type (dates and TIMESTAMP, but not TIMESTAMP_NTZ). An
    equality on a column of `points` skips those whose Bloom filter (or dictionary) lacks the value;
    `distinct` is the number of values a filter is laid out for, by default one a row. A value of
    the first column that holds many rows goes to many tasks if further columns of `by` tell its
    rows apart. The range sample reads the columns `by` of the source once more.
    """
    ordered = fact.repartitionByRange(*by).sortWithinPartitions(*by)
    writer = ordered.write.mode("overwrite").option("compression", "snappy").option("maxRecordsPerFile", rows)
    for name in points:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{name}", str(distinct or rows))
    writer.parquet(path)
    return path
