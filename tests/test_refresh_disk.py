"""What a refresh from messages leaves on disk while it runs."""

from __future__ import annotations

import gzip
import json
import threading
import time
from pathlib import Path

from pyspark.sql import functions as F

from riskflow import session
from riskflow.plans import refresh
from riskflow.schemas import CLIENTS, ENTITIES, LOGINS
from riskflow.sources import readers, writers
from riskflow.streaming import ingest


def logins(n):
    return [
        {"client_id": float(i), "login_date": "2024-05-06T07:08:09", "ip_address": "10.1.2.3", "location": f" at {i}, ", "device": None}
        for i in range(n)
    ]


def sent(spark, folder, bodies):
    folder.mkdir()
    (folder / "one").write_text("".join(json.dumps(b) + "\n" for b in bodies))
    return readers.file_messages(spark, str(folder))


def parts(folder):
    return sorted(p for p in Path(folder).rglob("part-*"))


def test_landed_messages_and_csv_files_are_compressed(spark, tmp_path):
    bodies = logins(5000)
    root = str(tmp_path / "out")
    path = ingest.ingest_to_csv(spark, sent(spark, tmp_path / "in", bodies), LOGINS, root)
    for folder, kind in ((f"{root}/logins/raw_json", ".json.gz"), (path, ".csv.gz")):
        files = parts(folder)
        assert files and all(p.name.endswith(kind) for p in files)
        text = sum(len(gzip.decompress(p.read_bytes())) for p in files)
        assert sum(p.stat().st_size for p in files) < text / 4
    found = readers.read_text_csv(spark, path, LOGINS).collect()
    assert sorted((float(r.client_id), r.location, r.device) for r in found) == [(b["client_id"], b["location"], None) for b in bodies]


def test_a_compressed_file_holds_a_bounded_number_of_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest, "PACKED", writers.PACKED | {"maxRecordsPerFile": "100"})
    assert int(writers.PACKED["maxRecordsPerFile"]) <= 1_000_000
    root = str(tmp_path / "out")
    path = ingest.ingest_to_csv(spark, sent(spark, tmp_path / "in", logins(950)), LOGINS, root)
    assert len(parts(f"{root}/logins/raw_json")) >= 10 and len(parts(path)) >= 10
    assert sorted(float(r.client_id) for r in readers.read_text_csv(spark, path, LOGINS).collect()) == [float(i) for i in range(950)]


def test_files_with_line_breaks_stay_plain_and_are_read_in_blocks(spark, tmp_path):
    bodies = [{n: None for n in CLIENTS.wire} | {"client_id": float(i), "client_address": f'Street "{i}",\nTown'} for i in range(300)]
    root = str(tmp_path / "out")
    messages = {n: sent(spark, tmp_path / n, bodies if n == "clients" else []) for n in ENTITIES}
    found = ingest.raw_from_messages(spark, messages, root)["clients"].collect()
    assert all(p.suffix == ".csv" for p in parts(f"{root}/clients/csv_files"))
    assert sorted((float(r.client_id), r.client_address) for r in found) == [(b["client_id"], b["client_address"]) for b in bodies]


def test_files_landed_before_are_read_with_compressed_ones(spark, tmp_path):
    raw = str(tmp_path / "out" / "logins" / "raw_json")
    messages = sent(spark, tmp_path / "in", logins(7))
    plain = messages.selectExpr("CAST(value AS STRING) AS raw_data").writeStream.format("json").option("path", raw)
    plain.option("checkpointLocation", str(tmp_path / "out" / "logins" / "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    (tmp_path / "in" / "two").write_text("".join(json.dumps(b | {"client_id": b["client_id"] + 7}) + "\n" for b in logins(5)))
    rows = ingest.ingest(spark, messages, LOGINS, str(tmp_path / "out"))
    assert {p.suffix for p in parts(raw)} == {".json", ".gz"}
    assert sorted(r.client_id for r in rows.collect()) == [float(i) for i in range(12)]


def shuffle_bytes(spark) -> int:
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return sum(f.stat().st_size for folder in folders for f in Path(folder).rglob("shuffle_*") if f.is_file())


def settled(spark) -> int:
    """Bytes of shuffle files after a while; they are removed in the background."""
    found = shuffle_bytes(spark)
    for _ in range(20):
        time.sleep(0.2)
        found = shuffle_bytes(spark)
    return found


def test_a_stored_table_leaves_no_shuffle_files(spark, tmp_path):
    before = settled(spark)
    rows = spark.range(200_000).select(F.xxhash64("id").alias("key")).groupBy("key").agg(F.count("*").alias("n"))
    table = writers.write_sorted(writers.write_refresh(rows, f"{tmp_path}/rows"), f"{tmp_path}/sorted", "key")
    assert settled(spark) <= before + 10_000
    assert table.count() == 200_000 and spark.conf.get(session._CLEANUP) == "false"


def test_marts_are_published_one_after_the_other(spark, tmp_path, monkeypatch):
    lock, running, most = threading.Lock(), [], []

    def load(mart, path):
        with lock:
            running.append(path)
            most.append(len(running))
        time.sleep(0.2)
        with lock:
            running.remove(path)
        return mart

    names = ("publish_activity", "publish_transactions", "publish_payments")
    for name in names:
        monkeypatch.setattr(refresh.publish, name, load)
    marts = {n: spark.range(1) for n in ("activity_logins", "transactions", "payments")}
    assert set(refresh.refresh_published(marts, str(tmp_path))) == set(marts)
    assert most == [1, 1, 1]
