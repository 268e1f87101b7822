"""Operators against brute force, hot keys included."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from riskflow.operators import clean, dims, faults, joins, quality, stats


def hot_pair(spark, rows=3000):
    """Both sides hold one client with a third of all rows."""
    left = spark.range(rows).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 100).cast("bigint").alias("client_id"),
        F.col("id").alias("a"),
    )
    right = spark.range(rows // 10).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 120).cast("bigint").alias("client_id"),
        F.col("id").alias("b"),
    )
    return left, right


@pytest.fixture()
def no_broadcast(spark):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set(adaptive, "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    spark.conf.unset(adaptive)


def brute_join(left, right):
    by_key = defaultdict(list)
    for k, b in right.collect():
        by_key[k].append(b)
    return Counter((k, a, b) for k, a in left.collect() for b in by_key[k])


def test_fan_out_join_keeps_every_pair_of_a_hot_key(spark, no_broadcast):
    left, right = hot_pair(spark)
    splits = joins.Splits(rows_per_task=50)
    pieces = {r.client_id: (r.left_pieces, r.right_pieces) for r in joins.hot_pieces(left, right, "client_id", splits).collect()}
    assert pieces[7][0] > 10 and pieces[7][1] > 1
    names = spark.range(110).select(F.col("id").alias("client_id"), F.concat(F.lit("n"), "id").alias("name"))
    joined = joins.fan_out_join(left, right, "client_id", ["a"], ["b"], [names], splits)
    rows = joined.select("client_id", "a", "b", "name").collect()
    assert Counter(tuple(r)[:3] for r in rows) == Counter(
        {k: n for k, n in brute_join(left, right).items() if k[0] < 110}
    )
    assert all(r.name == f"n{r.client_id}" for r in rows)


def test_fan_out_join_spreads_a_hot_key_over_tasks(spark, no_broadcast):
    left, right = hot_pair(spark)
    joined = joins.fan_out_join(left, right, "client_id", ["a"], ["b"], splits=joins.Splits(rows_per_task=50))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = joined.where("client_id = 7").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    whole = sum(t["count"] for t in tasks)
    assert len(tasks) > 4 and max(t["count"] for t in tasks) < whole / 2


def test_every_hot_key_is_cut_by_its_output(spark):
    left = spark.range(200 * 300).select((F.col("id") % 200).alias("client_id"), F.col("id").alias("a"))
    right = spark.range(200 * 300).select((F.col("id") % 200).alias("client_id"), F.col("id").alias("b"))
    pieces = joins.hot_pieces(left, right, "client_id", joins.Splits(output_per_task=10_000)).collect()
    assert len(pieces) == 200 and all((r.left_pieces, r.right_pieces) == (3, 3) for r in pieces)
    assert joins.hot_pieces(left, right, "client_id", joins.Splits(output_per_task=90_000)).isEmpty()


def test_a_long_key_on_both_sides_is_spread_though_one_side_fits_a_broadcast(spark):
    left = spark.range(3000).select(F.lit(7).alias("client_id"), F.col("id").alias("a"))
    right = spark.range(3000).select(F.lit(7).alias("client_id"), F.col("id").alias("b"))
    joined = joins.fan_out_join(left, right, "client_id", ["a"], ["b"], splits=joins.Splits(output_per_task=90_000))
    assert "SortMergeJoin" in joined._jdf.queryExecution().toString()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(t["count"] for t in tasks) == 9_000_000
    assert max(t["count"] for t in tasks) < 9_000_000 / 3


def test_fan_out_join_without_hot_keys_adds_nothing(spark, no_broadcast):
    left, right = hot_pair(spark)
    joined = joins.fan_out_join(left, right, "client_id", ["a"], ["b"])
    assert "Generate" not in joined._jdf.queryExecution().toString()
    assert Counter(map(tuple, joined.select("client_id", "a", "b").collect())) == brute_join(left, right)


def test_unique_join(spark, no_broadcast):
    left, _ = hot_pair(spark)
    names = spark.range(50).select(F.col("id").alias("client_id"), F.lit("x").alias("name"))
    joined = joins.unique_join(left, names, "client_id", ["a"], joins.Splits(rows_per_task=50))
    assert joined.count() == left.where("client_id < 50").count()


def test_keep_one_is_first_by_total_order(spark):
    rows = [(1, "b", 2), (1, "a", 9), (1, None, 5), (2, "z", 1), (2, "z", 1), (3, "q", None)]
    df = spark.createDataFrame(rows, "k int, s string, n int")
    assert sorted(map(tuple, clean.keep_one(df, ["k"]).collect())) == [(1, None, 5), (2, "z", 1), (3, "q", None)]
    assert sorted(map(tuple, clean.keep_one(df, ["k"], ["n"]).collect())) == [(1, "b", 2), (2, "z", 1), (3, "q", None)]


def test_keep_one_limits_a_hot_key_before_the_shuffle(spark):
    plan = clean.keep_one(spark.range(100).selectExpr("id % 3 AS k", "id"), ["k"])._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2 and "Partial" in plan


def test_require_pushes_down_and_drops_nan(spark, small):
    events = spark.read.parquet(f"{small}/events.parquet")
    plan = clean.require(events, ["user_id", "value"])._jdf.queryExecution().toString()
    assert "IsNotNull(user_id)" in plan and "IsNotNull(value)" in plan
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, "c")], "x double, s string")
    assert [r.s for r in clean.drop_missing_key(df, "x").collect()] == ["a"]


def test_distinct_undoes_repeats(spark, small):
    orders = spark.read.parquet(f"{small}/orders.parquet")
    repeated = faults.repeat_rows(orders, "o_orderkey", share=0.3, copies=3)
    assert repeated.count() > orders.count() * 1.5
    again = clean.distinct_rows(repeated)
    assert again.exceptAll(orders).isEmpty() and orders.exceptAll(again).isEmpty()


@pytest.mark.parametrize("rows", [0, 3, 777])
def test_numbering_is_dense_and_ordered(spark, rows):
    names = spark.range(rows).select(F.concat(F.lit("n"), F.lpad("id", 4, "0")).alias("name"))
    numbered = dims.number_rows(names.orderBy(F.rand(3)), ["name"], "key")
    assert [tuple(r) for r in numbered.orderBy("key").collect()] == [(i + 1, f"n{i:04d}") for i in range(rows)]


def test_dimension_and_lookup(spark):
    rows = [("USD", 1), ("usd", 2), ("Currency", 3), ("\\NaN\\", 4), (None, 5), ("RUB", 6), ("USD", 7)]
    df = spark.createDataFrame(rows, "currency string, n int")
    dim = dims.build_dim(df, "currency", "currency_id", "currency_name")
    assert [tuple(r) for r in dim.orderBy("currency_id").collect()] == [(1, "RUB"), (2, "USD"), (3, "usd")]
    found = dims.lookup(df, dim, "currency", "currency_id", "currency_name")
    assert sorted(map(tuple, found.collect())) == [(1, 6), (2, 1), (2, 7), (3, 2)]


@pytest.mark.parametrize(("accuracy", "task_rows"), [(4, 10), (50, 10), (50, 10_000), (100_000, 10)])
@pytest.mark.parametrize("shape", ["id * 1.37 % 251", "id % 2", "if(id % 3 = 0, 5, id)", "cast(null AS double)"])
def test_staged_quantiles_equal_the_built_in(spark, shape, accuracy, task_rows):
    df = spark.range(1999).selectExpr(f"cast({shape} AS double) AS x", "cast(id AS double) AS y")
    wanted = [0.0, 0.25, 0.5, 0.75, 1.0]
    staged = stats.exact_quantiles(df, ["x", "y"], wanted, accuracy, task_rows)
    built_in = df.agg(*[F.percentile(c, wanted).alias(c) for c in ("x", "y")]).first()
    for c in ("x", "y"):
        assert staged[c] == pytest.approx(built_in[c] or [None] * 5)


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "ab"), (1, "abc"), (2, None), (None, "x"), (5, "y")], "k int, s string")
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    found = quality.all_checks(
        quality.not_null(df, ["k", "s"]),
        quality.max_length(df, {"s": 2}),
        quality.primary_key(df, ["k"]),
        quality.foreign_key(df, "k", parent, "id"),
    )
    assert sorted(map(tuple, found.collect())) == [
        ("foreign_key", "k", 1), ("max_length", "s", 1), ("not_null", "k", 1), ("not_null", "s", 1), ("primary_key", "k", 2),
    ]


def test_faults_hit_about_the_wanted_share_and_are_stable(spark, small):
    orders = spark.read.parquet(f"{small}/orders.parquet")
    n = orders.count()
    holed = faults.blank_values(orders, "o_orderkey", ["o_custkey", "o_totalprice"], 0.2)
    again = faults.blank_values(orders.repartition(5), "o_orderkey", ["o_custkey", "o_totalprice"], 0.2)
    assert 0.1 * n < holed.where("o_custkey IS NULL").count() < 0.3 * n
    assert holed.exceptAll(again).isEmpty()
    dated = faults.wrong_dates(orders, "o_orderkey", "o_orderdate", 0.2)
    years = {r[0] for r in dated.select(F.year("o_orderdate")).distinct().collect()}
    assert set(faults.WRONG_YEARS) <= years and dated.count() == n
    assert faults.shuffle_rows(orders, 4).exceptAll(orders).isEmpty()
    burst = faults.add_bursts(orders, F.col("o_orderkey") == 5, 10)
    assert burst.count() == n + 10 and burst.where("o_orderkey = 5").count() == 11
