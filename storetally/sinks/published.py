"""Results of a run that readers see as a whole or not at all.

A run writes its results into a folder of its own and, when all are there, one manifest that
names them: a small file, written aside and renamed. Readers go by the manifests, never by
folders. So a run that dies leaves what was published before; a run that is
repeated under its id after it was published changes nothing, and before it was, it starts
afresh. One run at a time publishes to a path.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from storetally.session import remove_folder

MANIFESTS, RUNS = "_manifests", "_runs"


def _file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and its class of paths."""
    place = spark._jvm.org.apache.hadoop.fs.Path
    return place(path).getFileSystem(spark._jsc.hadoopConfiguration()), place


def manifests(spark: SparkSession, path: str) -> list[dict]:
    """What was published at `path`, in order: run id, number, and the folder of each result."""
    files, place = _file_system(spark, path)
    folder = place(f"{path.rstrip('/')}/{MANIFESTS}")
    if not files.exists(folder):
        return []
    found = []
    for status in files.listStatus(folder):
        if status.getPath().getName().endswith(".json"):
            stream = files.open(status.getPath())
            try:
                text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            found.append(json.loads(text))
    return sorted(found, key=lambda one: (one["number"], one["run"]))


def stage(results: Mapping[str, DataFrame], path: str, run: str) -> dict[str, str]:
    """Writes the results of a run into its folder; nobody reads them yet. Returns their folders by name."""
    folders = {}
    for name, result in results.items():
        folders[name] = f"{RUNS}/{run}/{name}"
        result.write.mode("overwrite").option("compression", "snappy").parquet(f"{path.rstrip('/')}/{folders[name]}")
    return folders


def publish(results: Mapping[str, DataFrame], path: str, run: str) -> bool:
    """Publishes the results of the run `run` (letters, digits, `-`, `_`); False if it was published before."""
    if not results or not run.replace("-", "").replace("_", "").isalnum():
        raise ValueError("a run has an id of letters, digits, - and _, and at least one result")
    spark = next(iter(results.values())).sparkSession
    before = manifests(spark, path)
    if any(one["run"] == run for one in before):
        return False
    remove_folder(spark, f"{path.rstrip('/')}/{RUNS}/{run}")
    manifest = {
        "run": run,
        "number": before[-1]["number"] + 1 if before else 1,
        "results": stage(results, path, run),
    }
    files, place = _file_system(spark, path)
    final = f"{path.rstrip('/')}/{MANIFESTS}/{run}.json"
    aside = place(f"{final}.new")
    stream = files.create(aside, True)
    try:
        stream.write(bytearray(json.dumps(manifest).encode()))
    finally:
        stream.close()
    if not files.rename(aside, place(final)):
        raise OSError(f"{final} could not be published")
    return True


def load_latest(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The result `name` of the run that was published last among those that have it."""
    return _load(spark, path, name)[-1]


def load_all(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The result `name` of every published run, each once."""
    first, *others = _load(spark, path, name)
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def _load(spark: SparkSession, path: str, name: str) -> list[DataFrame]:
    found = [one["results"][name] for one in manifests(spark, path) if name in one["results"]]
    if not found:
        raise FileNotFoundError(f"{name} was never published at {path}")
    return [spark.read.parquet(f"{path.rstrip('/')}/{folder}") for folder in found]
