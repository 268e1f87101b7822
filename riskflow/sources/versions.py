"""Tables that are replaced as a whole without a moment in which they are gone.

A table is a folder with one folder of files per version and a manifest per version:

    <path>/v000000000007-<id>/part-...          the rows of version 7
    <path>/_versions/000000000007.json          {"folder": ..., "schema": ...}

A load writes a new folder and, when all its rows are there, the manifest. The highest readable manifest is the table.
So a load that fails half-way leaves the table as it was, readers of the version before go on reading it, a table may
be computed from itself, and of two loads at the same time one fails. Files are made through Hadoop's file systems,
which the session reaches by the JVM; Spark Connect has no such access.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from riskflow.session import shuffles_released

MANIFESTS = "_versions"
_FOLDER = re.compile(r"v(\d{12})-[0-9a-f]{32}")


@dataclass(frozen=True)
class Version:
    number: int
    folder: str
    schema: T.StructType


class Conflict(RuntimeError):
    """Another load has replaced the table in the meantime."""


def _path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    folder, files = _path(spark, path)
    return [status.getPath().getName() for status in files.listStatus(folder)] if files.exists(folder) else []


def _read(spark: SparkSession, path: str, name: str) -> Version | None:
    file, files = _path(spark, f"{path}/{MANIFESTS}/{name}")
    stream = files.open(file)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        found = json.loads(text)
    except ValueError:  # its load was lost while it wrote the manifest
        return None
    return Version(int(name.removesuffix(".json")), found["folder"], T.StructType.fromJson(found["schema"]))


def _numbers(spark: SparkSession, path: str) -> list[str]:
    return sorted(n for n in _names(spark, f"{path}/{MANIFESTS}") if re.fullmatch(r"\d{12}\.json", n))


def versions(spark: SparkSession, path: str) -> list[Version]:
    """All versions that are still there, the oldest first."""
    found = [_read(spark, path, name) for name in _numbers(spark, path)]
    return [v for v in found if v]


def current(spark: SparkSession, path: str) -> Version | None:
    """The version that readers get; none where nothing has been loaded by ``replace``."""
    for name in reversed(_numbers(spark, path)):
        if found := _read(spark, path, name):
            return found
    return None


def read_version(spark: SparkSession, path: str, version: Version) -> DataFrame:
    return spark.read.schema(version.schema).parquet(f"{path}/{version.folder}")


def read_current(spark: SparkSession, path: str) -> DataFrame:
    found = current(spark, path)
    if found is None:
        raise FileNotFoundError(f"no version of a table in {path}")
    return read_version(spark, path, found)


def replace(df: DataFrame, path: str, compression: str, keep: int = 2) -> DataFrame:
    """Make ``df`` the next version of the table at ``path`` and return it as stored.

    The newest ``keep`` versions stay, so that queries that began before can end. The shuffle files behind it are removed.
    """
    spark = df.sparkSession
    taken = _numbers(spark, path)
    number = int(taken[-1].removesuffix(".json")) + 1 if taken else 1
    folder = f"v{number:012d}-{uuid.uuid4().hex}"
    with shuffles_released(spark):
        df.write.option("compression", compression).parquet(f"{path}/{folder}")
    manifest, files = _path(spark, f"{path}/{MANIFESTS}/{number:012d}.json")
    try:
        stream = files.create(manifest, False)  # fails where the file is there
    except Py4JJavaError as e:
        raise Conflict(f"version {number} of {path} has been written by another load") from e
    try:
        stream.write(bytearray(json.dumps({"folder": folder, "schema": df.schema.jsonValue()}).encode()))
    finally:
        stream.close()
    clean(spark, path, keep)
    return read_version(spark, path, Version(number, folder, df.schema))


def clean(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Remove all but the newest ``keep`` versions, and what failed loads before the current version left.

    A folder of a later number belongs to a load that is still running.
    """
    there = versions(spark, path)
    kept = there[-max(1, keep) :]
    if not kept:
        return
    for name in _names(spark, path):
        match = _FOLDER.fullmatch(name)
        if match and int(match[1]) <= kept[-1].number and name not in {v.folder for v in kept}:
            folder, files = _path(spark, f"{path}/{name}")
            files.delete(folder, True)
    for name in _numbers(spark, path):
        if int(name.removesuffix(".json")) < kept[0].number:
            file, files = _path(spark, f"{path}/{MANIFESTS}/{name}")
            files.delete(file, False)
