"""CSV records with line breaks, read in blocks of any size."""

from __future__ import annotations

import csv
import io

import pytest

from riskflow.schemas import CLIENTS
from riskflow.sources import readers, writers
from riskflow.sources.records import read_records

BLOCK = "spark.sql.files.maxPartitionBytes"


def people(n):
    rows = []
    for i in range(n):
        address = ['Street "5"\nTown', "plain", "a\n\n\nb,c\n", "x" * (i % 700), 'ends in "quotes"', None, "\\NaN\\"][i % 7]
        rows.append((f"{i}.0", f"n{i}", "Ünï", None, "+1", address, None))
    return rows


@pytest.fixture
def blocks(spark):
    def set_size(size):
        spark.conf.set(BLOCK, str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield set_size
    spark.conf.unset(BLOCK)
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("size", [97, 1000, 1 << 20])
def test_clients_come_back_from_blocks_of_any_size(spark, tmp_path, blocks, size):
    given = people(300)
    path = str(tmp_path / "clients")
    writers.write_csv(spark.createDataFrame(given, CLIENTS.text_schema).coalesce(2), path)
    blocks(size)
    found = readers.read_text_csv(spark, path, CLIENTS)
    kept = [tuple(v if v != "" else None for v in r) for r in given]
    assert sorted(map(str, (tuple(r) for r in found.collect()))) == sorted(map(str, kept))
    tasks = read_records(spark, path).select("file", "block").distinct().count()
    assert tasks > 100 if size == 97 else tasks >= 2


def test_one_record_over_many_blocks(spark, tmp_path, blocks):
    body = io.StringIO()
    long = "line\n" * 200
    csv.writer(body, lineterminator="\n").writerows([["a", "b"], ["1", long], ["2", "short"], ["3", long + "end"], ["4", ""]])
    (tmp_path / "f.csv").write_text(body.getvalue())
    (tmp_path / "g.csv").write_text('a,"b\nc"\r\n5,"x\ny"\r\n\r\n')
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header.csv").write_text("a,b\n")
    blocks(64)
    got = [r.record for r in read_records(spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted([f'1,"{long}"', "2,short", f'3,"{long}end"', "4,", '5,"x\ny"'])
    with_header = [r.record for r in read_records(spark, str(tmp_path), header=False).collect()]
    assert len(with_header) == len(got) + 3 and 'a,"b\nc"' in with_header


def test_typed_clients(spark, tmp_path, blocks):
    path = str(tmp_path / "clients")
    writers.write_csv(spark.createDataFrame([*people(40), ("x", *[None] * 6)], CLIENTS.text_schema), path)
    blocks(150)
    from pyspark.sql import types as T

    found = readers.read_typed_csv(spark, path, CLIENTS, {"client_id": T.DoubleType()})
    assert sorted(r.client_id for r in found.where("client_id is not null").collect()) == [float(i) for i in range(40)]
    assert found.where("client_id is null").count() == 1
