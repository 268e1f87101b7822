"""Aggregates over fan-outs against the joined rows, and sampled quantiles."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from riskflow.operators.eager import aggregate_fan_out
from riskflow.operators.stats import exact_quantiles, merged_hashes, sampled_quantiles, smallest_hashes


def test_equal_to_the_joined_rows(spark):
    left = spark.range(600).selectExpr("if(id % 3 = 0, 7, id % 20) AS k", "id % 5 AS day", "if(id % 11 = 0, null, cast(id AS decimal(15,2)) / 4) AS amount")
    left = left.union(spark.createDataFrame([(None, 1, None)], left.schema))
    right = spark.range(300).selectExpr("if(id % 2 = 0, 7, id % 31) AS k", "id AS x").union(spark.createDataFrame([(None, 5)], "k long, x long"))
    third = spark.createDataFrame([(7,), (7,), (3,), (4,), (99,)], "k long")
    joined = left.join(right, "k").join(third, "k").groupBy("k", "day")
    want = joined.agg(F.count(F.lit(1)).alias("n"), F.count("amount").alias("with_amount"), F.sum("amount").alias("total"))
    got = aggregate_fan_out(left, [right, third], "k", {"day": F.col("day")}, {"n": F.lit(1), "with_amount": F.col("amount")}, {"total": F.col("amount")})
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() > 5


def test_no_joined_rows(spark):
    """A key of 60 000 rows on each side: the joined rows would be 3.6 billion."""
    left = spark.range(60_000).selectExpr("if(id >= 0, 1L, 2L) AS k", "id % 3 AS day", "cast(1.5 AS decimal(15,2)) AS amount")
    right = spark.range(60_000).selectExpr("if(id >= 0, 1L, 2L) AS k")
    got = aggregate_fan_out(left, [right], "k", {"day": F.col("day")}, {"n": F.lit(1)}, {"total": F.col("amount")})
    rows = got.collect()
    assert {r.day: (r.n, r.total) for r in rows} == {d: (20_000 * 60_000, 30_000 * 60_000) for d in range(3)}
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert len(joins) == 1
    below = plan[plan.index(joins[0]) :]
    assert below.count("HashAggregate") >= 4  # both sides are aggregated before they meet


@pytest.mark.parametrize("size", [300, 5000])
def test_sampled_quantiles(spark, size):
    rows = spark.range(20_000).selectExpr("id", "sqrt(id) AS a", "if(id % 4 = 0, null, -id) AS b", "cast(null AS double) AS c")
    found = sampled_quantiles(rows, ["a", "b", "c"], [0.25, 0.5, 0.75], ["id"], size)
    again = sampled_quantiles(rows.repartition(7, "a"), ["a", "b", "c"], [0.25, 0.5, 0.75], ["id"], size)
    assert found == again and found["c"] == [None] * 3
    for p, v in zip((0.25, 0.5, 0.75), found["a"]):
        assert abs(v * v / 20_000 - p) < 4 * (p * (1 - p) / size) ** 0.5
    everything = sampled_quantiles(rows, ["a", "b"], [0.1, 0.9], ["id"], 1 << 20)
    assert {c: [round(v, 6) for v in q] for c, q in everything.items()} == {
        c: [round(v, 6) for v in q] for c, q in exact_quantiles(rows, ["a", "b"], [0.1, 0.9]).items()
    }


def test_samples_merge(spark):
    rows = spark.range(9000).selectExpr("id", "cast(id AS double) AS a")
    parts = [smallest_hashes(rows.where(f"id % 3 = {i}"), "a", ["id"], 200) for i in range(3)]
    whole = smallest_hashes(rows, "a", ["id"], 200)
    assert sorted(merged_hashes(parts, 200).collect()) == sorted(whole.collect())
