"""Spark session and shared working folder."""

from __future__ import annotations

import atexit
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession

# Settings the results depend on. Physical tuning (shuffle partitions, memory,
# broadcast threshold) belongs to the cluster and is left alone.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Money sums are BIGINT cents; with ANSI mode an overflow raises.
    "spark.sql.ansi.enabled": "true",
    # Nanosecond Parquet timestamps arrive as BIGINT, see sources.conform.
    "spark.sql.legacy.parquet.nanosAsLong": "true",
}


def build_session(app_name: str = "storetally", **extra: str) -> SparkSession:
    """Session with the settings above; `extra` holds further settings by name."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_base(spark: SparkSession) -> str:
    """The folder for intermediate data that the cluster names: `spark.checkpoint.dir`, else the warehouse's.

    On a cluster a warehouse on the local disk would be another folder on each machine, so it is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    place = spark._jvm.org.apache.hadoop.fs.Path(warehouse)
    scheme = place.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme()
    if scheme == "file" and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{warehouse}/_runs"


def run_folder(spark: SparkSession, label: str) -> str:
    """A new folder path for one run, below the folder the cluster shares."""
    return f"{shared_base(spark)}/{label}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder, if it is there, wherever Spark can reach it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def remove_at_end(spark: SparkSession, path: str) -> None:
    """Deletes a folder of intermediate data when Python ends, if the session still runs then."""

    def remove() -> None:
        try:
            remove_folder(spark, path)
        except (Py4JError, ConnectionError, AttributeError, TypeError):
            return

    atexit.register(remove)
