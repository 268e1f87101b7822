"""Refresh, ingest and storage."""

from __future__ import annotations

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from checks.standins import ORDER_BOUNDS, raw_tables
from riskflow.operators.joins import Splits
from riskflow.plans import refresh
from riskflow.plans.dds import fact_logins
from riskflow.plans.ods import ods_transactions
from riskflow.schemas import CLIENTS, ENTITIES, PAYMENTS, TRANSACTIONS
from riskflow.session import work_path
from riskflow.sources import readers, writers
from riskflow.streaming.ingest import ingest, land

BOUNDS = {"logins": ORDER_BOUNDS, "transactions": ORDER_BOUNDS}


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_refresh_twice_gives_the_same_tables(spark, small, tmp_path):
    raw = raw_tables(spark, small)
    once = refresh.refresh_all(raw, str(tmp_path), bounds=BOUNDS)
    kept = {n: df.collect() for n, df in once["dm"].items()}
    twice = refresh.refresh_all(raw, str(tmp_path), bounds=BOUNDS, splits=Splits(rows_per_task=20))
    for name, df in twice["dm"].items():
        assert sorted(map(str, df.collect())) == sorted(map(str, kept[name]))
    star, marts, published = twice["dds"], twice["dm"], twice["published"]
    fan_out = (
        star["clients_activity"].groupBy("client_id").agg(F.count("*").alias("a"))
        .join(star["logins"].groupBy("client_id").agg(F.count("*").alias("l")), "client_id")
        .join(star["clients"], "client_id").agg(F.sum(F.col("a") * F.col("l")))
    ).first()[0]
    assert marts["activity_logins"].count() == fan_out
    assert published["activity_logins"].count() == fan_out
    assert [len(marts[m].columns) for m in ("activity_logins", "transactions", "payments")] == [17, 15, 15]
    assert dict(published["activity_logins"].dtypes)["ip_address_login"] == "bigint"


def test_a_repeated_client_id_stops_the_refresh_before_the_marts(spark, small, tmp_path):
    raw = raw_tables(spark, small)
    renamed = raw["clients"].limit(5).withColumn("client_last_name", F.lit("Other"))
    raw["clients"] = raw["clients"].unionByName(renamed)
    with pytest.raises(ValueError, match="client ids are repeated"):
        refresh.refresh_all(raw, str(tmp_path), bounds=BOUNDS)
    assert (tmp_path / "dds" / "clients").exists() and not (tmp_path / "dm").exists()


def test_facts_read_only_what_the_bounds_allow(spark, small, tmp_path):
    typed = refresh.refresh_ods(raw_tables(spark, small), str(tmp_path))
    plan = fact_logins(typed["logins"], ORDER_BOUNDS)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(login_date" in plan and "IsNotNull(client_id)" in plan


def test_amounts_with_binary_noise(spark):
    text = spark.createDataFrame([("1", "7", "4567.800000000001"), ("1", "8", "45.5")], "client_id string, transaction_id string, amount string")
    wide = text.select(*[F.col(c) if c in text.columns else F.lit("x").alias(c) for c in TRANSACTIONS.wire])
    strict = {r.transaction_id: r.amount for r in ods_transactions(wide).collect()}
    rounding = {r.transaction_id: r.amount for r in ods_transactions(wide, strict=False).collect()}
    assert strict[7] is None and str(rounding[7]) == "4567.80" and str(strict[8]) == str(rounding[8]) == "45.50"


def test_messages_with_bare_missing_values(spark, tmp_path):
    lines = [
        '{"client_id": NaN, "client_first_name": "Ann", "client_birthday": "NaT"}',
        '{"client_id": 5.0, "client_first_name": NaN, "client_birthday": "1990-05-06", "client_address": "a\\nb, \\"c\\""}',
        "no json",
    ]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "part.txt").write_text("\n".join(lines))
    rows = ingest(spark, readers.file_messages(spark, str(tmp_path / "in")), CLIENTS, str(tmp_path / "out"))
    found = rows.collect()
    assert len(found) == 1 and found[0].client_id == 5.0 and found[0].client_first_name == '"NaN"'
    assert str(found[0].client_birthday) == "1990-05-06 00:00:00"
    writers.write_csv(rows, str(tmp_path / "csv"))
    back = readers.read_text_csv(spark, str(tmp_path / "csv" / "*.csv"), CLIENTS).collect()
    assert len(back) == 1 and back[0].client_address == 'a\nb, "c"' and back[0].client_first_name == '"NaN"'
    assert back[0].client_birthday == "1990-05-06T00:00:00.000Z"


def test_landing_that_takes_too_long_hands_nothing_on(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for part in range(20):
        (tmp_path / "in" / f"{part}.txt").write_text(json.dumps({"client_id": float(part)}))
    messages = readers.file_messages(spark, str(tmp_path / "in"), maxFilesPerTrigger="1")
    with pytest.raises(TimeoutError):
        ingest(spark, messages, CLIENTS, str(tmp_path / "out"), seconds=0.2)
    assert ingest(spark, messages, CLIENTS, str(tmp_path / "out")).count() == 20


def test_large_amounts_survive_csv(spark, tmp_path):
    amounts = [0.0005, 9999999.99, 1e7, 12345678.5, 123456789012.25, -2.5e8, 5.0, None]
    rows = spark.createDataFrame([(a,) for a in amounts], "amount double")
    writers.write_csv(rows, str(tmp_path / "csv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    texts = [r.amount for r in back.collect()]
    assert not any("E" in t for t in texts if t)
    assert sorted(float(t) for t in texts if t) == sorted(a for a in amounts if a is not None)


def test_landing_goes_on_where_it_stopped(spark, tmp_path):
    source, raw, check = tmp_path / "in", str(tmp_path / "raw"), str(tmp_path / "check")
    source.mkdir()
    total = 0
    for part in range(3):
        lines = [json.dumps({"client_id": float(i), "payment_id": float(part)}) for i in range(10)]
        (source / f"{part}.txt").write_text("\n".join(lines))
        total += 10
        land(readers.file_messages(spark, str(source), maxFilesPerTrigger="1"), raw, check)
        assert spark.read.json(raw).count() == total
    land(readers.file_messages(spark, str(source)), raw, check)
    rows = readers.read_json(spark, raw, "raw_data string")
    assert rows.distinct().count() == total == rows.count()


def test_sorted_files_have_disjoint_ranges_but_for_hot_keys(spark, tmp_path):
    df = spark.range(20000).selectExpr("if(id % 3 = 0, 500, id % 1000) AS k", "id % 2 AS v")
    stored = writers.write_sorted(df, str(tmp_path / "t"), "k", partitions=8)
    assert same(stored, df)
    files = stored.groupBy(F.input_file_name().alias("f")).agg(F.min("k").alias("lo"), F.max("k").alias("hi"), F.count("*").alias("n"))
    ranges = sorted((r.lo, r.hi, r.n) for r in files.collect())
    assert len(ranges) == 8
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
    assert max(r[2] for r in ranges) < 20000 / 3


def test_bucketed_tables_join_without_a_shuffle(spark, small, tmp_path):
    orders = spark.read.parquet(f"{small}/orders.parquet")
    a = writers.write_bucketed(orders, "bucketed_a", str(tmp_path / "a"), "o_custkey", 4)
    b = writers.write_bucketed(orders.select("o_custkey", "o_orderkey"), "bucketed_b", str(tmp_path / "b"), "o_custkey", 4)
    plan = a.hint("merge").join(b, "o_custkey")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    spark.sql("DROP TABLE bucketed_a")
    spark.sql("DROP TABLE bucketed_b")


def test_a_hot_bucket_is_written_by_several_tasks(spark, tmp_path):
    df = spark.range(200_000).selectExpr("if(id % 3 = 0, 7, id % 5000) AS k", "uuid() AS v")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        stored = writers.write_bucketed(df, "bucketed_hot", str(tmp_path / "t"), "k", 8)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert stored.count() == 200_000
    files = stored.select("k", F.input_file_name().alias("f")).distinct().groupBy("k").agg(F.count("*").alias("n"))
    assert files.where("k = 7").first().n > 1
    assert files.where("n = 1").count() > 5000 / 2
    spark.sql("DROP TABLE bucketed_hot")


def test_reading_an_empty_folder_falls_back(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    rows = readers.read_json_inferred(spark, str(tmp_path / "empty"), PAYMENTS.wire_schema)
    assert rows.columns == list(PAYMENTS.wire) and rows.isEmpty()


def test_tables_by_path_and_by_name(spark, small):
    spark.read.parquet(f"{small}/nation.parquet").createOrReplaceTempView("nations")
    assert readers.read_table(spark, "nations").count() == readers.read_table(spark, f"{small}/nation.parquet").count()


def test_jdbc_arguments_reach_the_reader(spark):
    source = dict(url="jdbc:none:x", table="t", column="client_id", lower="0", upper="9", partitions=3)
    with pytest.raises(Exception, match="(?i)driver"):
        readers.read_table(spark, source)


def test_kafka_needs_its_connector(spark):
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        readers.kafka_messages(spark, "broker:9092", "transactions", maxOffsetsPerTrigger="1000")
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        writers.write_kafka(spark.range(1), "broker:9092", "transactions")


def test_work_folder_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    path = work_path(spark, "t")
    assert named is None or path.startswith(named)
    assert set(ENTITIES) == {"clients", "clients_activity", "logins", "payments", "transactions"}
