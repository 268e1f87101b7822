"""Detectors: hand-made cases and planted anomalies."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from riskflow import daily_profile, iqr_global, zscore_by_day, zscore_global
from riskflow.operators import faults

MARCH_1, MARCH_2 = dt.date(2025, 3, 1), dt.date(2025, 3, 2)


def test_by_day_hand_made(spark):
    rows = [(float(c), "2025-03-01 10:00:00", 5.0) for c in range(1, 41)]
    rows += [(7.0, "2025-03-01 11:00:00", 5.0)] * 10 + [(99.0, "2025-03-02 10:00:00", 5.0)] * 50
    rows += [(float("nan"), "2025-03-01 10:00:00", 1e9)] * 60 + [(None, "2025-03-01 10:00:00", 1e9)]
    rows += [(8.0, "2025-03-01 10:00:00", float("nan")), (8.0, None, 1e9)]
    df = spark.createDataFrame(rows, "client_id double, transaction_date string, amount double")
    found = zscore_by_day(df.withColumn("transaction_date", F.col("transaction_date").cast("timestamp"))).collect()
    assert len(found) == 1
    row = found[0]
    assert (row.client_id, row.transaction_date, row.transaction_count) == ("7", MARCH_1, 11)
    assert abs(row.avg_transaction_count - 1.25) < 1e-12 and abs(row.stddev_transaction_count - 1.581139) < 1e-6
    assert row.is_count_anomaly and row.is_amount_anomaly


def plain_days(spark, clients=60, days=20):
    """One or two transactions of about the same size per client and day."""
    base = spark.range(clients * days * 2).selectExpr(
        f"id % {clients} AS client_id",
        f"timestampadd(DAY, cast(id div {clients} AS int) % {days}, timestamp'2025-03-01 09:00:00') AS transaction_date",
        "id AS transaction_id",
        "cast(100 + id % 7 AS decimal(15,2)) AS total_amount",
    )
    return base.where("transaction_id % 5 <> 0")


def keys(df, day):
    return {(int(r.client_id), r[day]) for r in df.collect()}


def test_planted_anomalies_are_found(spark):
    rows = plain_days(spark)
    large = (F.col("client_id") == 11) & (F.to_date("transaction_date") == F.lit(dt.date(2025, 3, 4)))
    rows = rows.withColumn("total_amount", F.when(large, F.col("total_amount") * 10).otherwise(F.col("total_amount")))
    start = F.col("transaction_id") == 60 * 7 + 23  # client 23 on March 8
    rows = faults.add_bursts(rows, start, 10).withColumn("amount", F.col("total_amount"))
    planted = {(11, dt.date(2025, 3, 4)), (23, dt.date(2025, 3, 8))}
    profile = daily_profile(rows)
    assert keys(zscore_global(profile), "transaction_day") == planted
    assert planted <= keys(iqr_global(profile), "transaction_day")
    assert planted <= keys(iqr_global(profile, exact=False), "transaction_day")
    assert planted <= keys(zscore_by_day(rows), "transaction_date")


def test_few_rows_flag_nothing(spark):
    profile = daily_profile(plain_days(spark).limit(1))
    assert zscore_global(profile).isEmpty() and iqr_global(profile).isEmpty()
    empty = daily_profile(plain_days(spark).where("client_id < 0"))
    assert zscore_global(empty).isEmpty() and iqr_global(empty).isEmpty()


def test_profile_is_shuffled_once(spark, small):
    events = spark.read.parquet(f"{small}/events.parquet")
    found = zscore_global(daily_profile(events, "user_id", "ts", "event_id", "value"))
    assert found.count() == 11
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "ReusedExchange" in found._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
