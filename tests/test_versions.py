"""Replacing stored tables: failures half-way, tables computed from themselves, conflicts, cleaning."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from riskflow.sources import readers, versions, writers


def folders(path):
    return sorted(n for n in os.listdir(path) if n.startswith("v"))


def test_a_load_that_fails_half_way_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_refresh(spark.range(100), path)
    reader = readers.read_table(spark, path)
    broken = spark.range(0, 1000, 1, 8).select(F.when(F.col("id") == 999, F.raise_error(F.lit("broken row"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken row"):
        writers.write_refresh(broken, path)
    assert readers.read_table(spark, path).count() == reader.count() == 100
    assert len(folders(path)) == 2 and len(versions.versions(spark, path)) == 1
    writers.write_refresh(spark.range(7), path)
    assert readers.read_table(spark, path).count() == 7
    assert len(folders(path)) == 2 and reader.count() == 100  # what the failed load left is gone, the version before is not


def test_a_table_is_rewritten_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_refresh(spark.range(10), path)
    for n in range(1, 4):
        stored = writers.write_refresh(readers.read_table(spark, path).union(spark.range(10 * n, 10 * n + 10)), path)
        assert sorted(r.id for r in stored.collect()) == list(range(10 * n + 10))
    assert [v.number for v in versions.versions(spark, path)] == [3, 4] and len(folders(path)) == 2


def test_of_two_loads_at_a_time_one_fails(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    writers.write_refresh(spark.range(3), path)
    known = versions._numbers(spark, path)
    writers.write_refresh(spark.range(4), path)
    numbers, first = versions._numbers, []
    monkeypatch.setattr(versions, "_numbers", lambda s, p: numbers(s, p) if first else first.append(1) or known)
    with pytest.raises(versions.Conflict):
        writers.write_refresh(spark.range(5), path)
    assert readers.read_table(spark, path).count() == 4


def test_a_torn_manifest_is_passed_over(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_refresh(spark.range(3), path)
    (tmp_path / "t" / versions.MANIFESTS / "000000000002.json").write_text('{"folder": "v0000')
    assert readers.read_table(spark, path).count() == 3
    writers.write_refresh(spark.range(5), path)
    assert readers.read_table(spark, path).count() == 5 and versions.current(spark, path).number == 3


def test_schema_and_plain_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(6).write.parquet(path)
    assert readers.read_table(spark, path).count() == 6
    with pytest.raises(FileNotFoundError):
        versions.read_current(spark, path)
    schema = spark.createDataFrame([], "id string, n int").schema
    writers.write_refresh(spark.range(2).withColumn("n", F.lit(1).cast("long")), path, schema)
    assert readers.read_table(spark, path).dtypes == [("id", "string"), ("n", "int")]
    assert versions.read_current(spark, path).count() == 2
    empty = writers.write_refresh(spark.range(0), str(tmp_path / "none"))
    assert empty.count() == 0 and readers.read_table(spark, str(tmp_path / "none")).columns == ["id"]
