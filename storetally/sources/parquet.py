"""Parquet readers.

`table` names the declared schema: transactions, flat, items, stores, products.
Nothing is cached by default, for a cache holds whole rows and so defeats column
pruning; `keep` caches chosen columns where several analyses share them.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from storetally.schemas import DECLARED, REQUIRED

# Names of the files.
CHUNKS = {
    "transactions": "transactions_chunk_*.parquet",
    "flat": "transactions_chunk_*.parquet",
    "items": "transaction_items_chunk_*.parquet",
}
MASTERS = {"stores": "stores_master.parquet", "products": "products_master.parquet"}

FOOTERS_AT_ONCE = 16
# The bucket in the name of a file that Spark wrote.
BUCKET = re.compile(r"_(\d+)(?:\.c\d+)?\.[a-z]")
# A bucket of so many times the median one is uneven.
UNEVEN = 5.0
SMALL_INTEGERS = (ByteType, ShortType, IntegerType)
WIDENS = {
    LongType: SMALL_INTEGERS,
    DoubleType: (*SMALL_INTEGERS, FloatType),
    StringType: (*SMALL_INTEGERS, LongType),
    TimestampType: (TimestampNTZType,),
}


class SchemaMismatch(ValueError):
    """A table lacks required columns or holds another type than declared."""


def load_chunks(spark: SparkSession, path: str, table: str = "transactions") -> DataFrame:
    """Chunks right below `path`, each a file or a folder as Spark writes it."""
    return conform(spark.read.parquet(f"{path.rstrip('/')}/{CHUNKS[table]}"), table)


def load_mixed_chunks(spark: SparkSession, path: str, table: str = "transactions") -> DataFrame:
    """Chunks right below `path` whose files may differ in their types, such as INT32 beside INT64 or times
    in nanoseconds beside microseconds.

    Chunks of equal schema are read together; each such group is conformed, and the groups are
    joined by column name, with NULLs where one lacks a further column. The schemas come
    from the chunks' footers, several read at a time (one small job each).
    """
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{CHUNKS[table]}")
    files = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    chunks = [status.getPath().toString() for status in files.globStatus(pattern) or []]
    if not chunks:
        raise FileNotFoundError(f"no {CHUNKS[table]} below {path}")
    with ThreadPoolExecutor(FOOTERS_AT_ONCE) as pool:
        schemas = pool.map(lambda chunk: spark.read.parquet(chunk).schema.json(), chunks)
        groups: dict[str, list[str]] = {}
        for chunk, schema in zip(chunks, schemas):
            groups.setdefault(schema, []).append(chunk)
    frames = [conform(spark.read.parquet(*group), table) for group in groups.values()]
    found = frames[0]
    for frame in frames[1:]:
        found = found.unionByName(frame, allowMissingColumns=True)
    return found


def load_filtered(
    spark: SparkSession, path: str, table: str = "transactions", pattern: str | None = None
) -> DataFrame:
    """Chunk files of one folder by name filter, without schema merging.

    The filter tests file names. Files written by Spark are named `part-*.parquet`;
    for chunks that are folders use `load_chunks`.
    """
    reader = spark.read.option("mergeSchema", "false").option("pathGlobFilter", pattern or CHUNKS[table])
    return conform(reader.parquet(path), table)


def load_recursive(
    spark: SparkSession, path: str, table: str = "transactions", pattern: str | None = None
) -> DataFrame:
    """Chunk files at any depth below `path`; folder names are not columns here.

    The name filter keeps store, product and item files of the same tree out.
    Small files share a task (`spark.sql.files.maxPartitionBytes`).
    """
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern or CHUNKS[table])
    return conform(reader.parquet(path), table)


def load_partitioned(spark: SparkSession, path: str, table: str = "transactions") -> DataFrame:
    """Fact partitioned in folders; filters on year and month skip folders."""
    return conform(spark.read.parquet(path), table)


def bucket_bytes(spark: SparkSession, path: str) -> dict[int, int]:
    """Bytes of each bucket of a folder written by `save_bucketed`, from the file listing; empty ones are absent."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found: dict[int, int] = {}
    for status in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder):
        named = BUCKET.search(status.getPath().getName())
        if named:
            found[int(named[1])] = found.get(int(named[1]), 0) + status.getLen()
    return found


def load_bucketed(spark: SparkSession, path: str, by: str, buckets: int, uneven: float = UNEVEN) -> DataFrame:
    """A folder written by `save_bucketed`, so that joins and groups on `by` need no shuffle.

    Two such tables join without one if their number of buckets is the same. A bucket is the work of
    one task. So if one has more than `uneven` times the bytes of the median bucket and more than Spark's
    threshold for a skewed partition, for it holds a hot key, the folder is read as plain files: Spark then
    shuffles on `by` where it must, and AQE splits the hot key in joins.
    """
    sizes = sorted(bucket_bytes(spark, path).values())
    plain = spark.read.parquet(path)
    least = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")
    )
    if not sizes or (sizes[-1] > least and sizes[-1] > uneven * sizes[len(sizes) // 2]):
        return plain
    name = f"storetally_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in plain.schema)
    place = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{by}`) INTO {buckets} BUCKETS LOCATION '{place}'"
    )
    try:
        return spark.table(name)
    finally:
        # The frame has found its files; the folder is not the catalog's.
        spark.sql(f"DROP TABLE {name}")


def load_stores(spark: SparkSession, path: str) -> DataFrame:
    return conform(spark.read.parquet(f"{path.rstrip('/')}/{MASTERS['stores']}"), "stores")


def load_products(spark: SparkSession, path: str) -> DataFrame:
    return conform(spark.read.parquet(f"{path.rstrip('/')}/{MASTERS['products']}"), "products")


def conform(df: DataFrame, table: str) -> DataFrame:
    """Declared columns in declared types, further columns as they are.

    Raises if a required column is absent or a type could not be widened without
    changing values. BIGINT where a timestamp is declared holds nanoseconds
    (`spark.sql.legacy.parquet.nanosAsLong`).
    """
    missing = [name for name in REQUIRED[table] if name not in df.columns]
    if missing:
        raise SchemaMismatch(f"{table}: missing columns {', '.join(missing)}")
    declared = {field.name: field.dataType for field in DECLARED[table]}
    return df.select(
        *[
            as_declared(field.name, field.dataType, declared.get(field.name, field.dataType)).alias(field.name)
            for field in df.schema
        ]
    )


def as_declared(name: str, found: DataType, declared: DataType) -> Column:
    column = F.col(f"`{name}`")
    # DECIMAL amounts stay as they are: DOUBLE would change long ones.
    if found == declared or (isinstance(declared, DoubleType) and isinstance(found, DecimalType)):
        return column
    if isinstance(declared, TimestampType) and isinstance(found, LongType):
        # Whole-number division: `/` would go through DOUBLE.
        return F.timestamp_micros(F.expr(f"`{name}` div 1000"))
    if isinstance(found, WIDENS.get(type(declared), ())):
        return column.cast(declared)
    raise SchemaMismatch(f"{name}: {found.simpleString()} where {declared.simpleString()} is declared")


def check_unique(df: DataFrame, key: str) -> int:
    """Number of rows; raises if `key` repeats or is NULL (runs one job)."""
    found = df.agg(F.count("*").alias("row_count"), F.countDistinct(key).alias("keys")).first()
    if found["row_count"] != found["keys"]:
        raise ValueError(f"{key} is not unique: {found['row_count']} rows, {found['keys']} keys")
    return found["row_count"]


def keep(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Caches the given columns for several analyses; release with `unpersist()`."""
    return df.select(*columns).persist()
