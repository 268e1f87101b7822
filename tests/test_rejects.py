"""Loads with rejects: which rule is named, what a key keeps, and that every row is accounted for."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from checks.standins import ORDER_BOUNDS, raw_tables
from riskflow.operators.rejects import RULE, Known, Rule, in_range, judge, max_length, not_null, reject_counts
from riskflow.plans import refresh

BOUNDS = {"logins": ORDER_BOUNDS, "transactions": ORDER_BOUNDS}


def rules():
    return [*not_null(["id"]), *in_range("day", ("2020-01-01", "2020-12-31"), "date"), *max_length({"name": 3})]


def test_the_first_broken_rule_is_named(spark):
    rows = [
        (1, "2020-05-05", "a", 5), (1, "2020-05-05", "a", 3), (1, "2020-05-04", None, 9), (None, "1999-01-01", "long", 1),
        (2, "1999-01-01", "long", 1), (2, None, "b", 1), (3, "2020-12-31", "long", 1), (3, "2020-12-31", "zz", 1), (4, "2020-01-01", "b", None),
    ]
    df = spark.createDataFrame(rows, "id long, day string, name string, n long").withColumn("day", F.col("day").cast("date"))
    names = spark.createDataFrame([("a",), ("b",)], "title string")
    found = judge(df, rules(), [Known("name", names, "title")], ["id"], ["day", "n"])
    got = sorted((str(r.id), str(r.day), str(r["name"]), str(r.n), r[RULE]) for r in found.rejected.collect())
    assert got == sorted([
        ("1", "2020-05-05", "a", "5", "primary_key"), ("1", "2020-05-04", "None", "9", "known:name"), ("None", "1999-01-01", "long", "1", "not_null:id"),
        ("2", "1999-01-01", "long", "1", "date_range:day"), ("2", "None", "b", "1", "date_range:day"),
        ("3", "2020-12-31", "long", "1", "max_length:name"), ("3", "2020-12-31", "zz", "1", "known:name"),
    ])
    assert sorted((r.id, r.n) for r in found.accepted.collect()) == [(1, 3), (4, None)]
    assert found.accepted.columns == df.columns
    assert {(r.table_name, r[RULE]): r.rows for r in reject_counts({"t": found.rejected}).collect()}["t", "known:name"] == 2


def test_nulls_in_keys_and_conditions(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, None)], "k long, v long")
    found = judge(df, [Rule("big", F.col("v") > 5)], key=["k"], order=["v"])
    assert sorted(map(str, found.accepted.collect())) == ["Row(k=1, v=None)", "Row(k=None, v=1)"]
    nothing = judge(df.limit(0), [Rule("big", F.col("v") > 5)], key=["k"])
    assert nothing.accepted.count() == nothing.rejected.count() == 0
    assert judge(df, []).accepted.count() == 3


def test_a_hot_key(spark):
    df = spark.range(60_000).selectExpr("if(id % 3 = 0, 7L, id) AS k", "id AS v")
    found = judge(df, [], key=["k"], order=["v"])
    assert found.rejected.count() == 20_000 - 1 + 1  # the hot key's rows but one, of which one is 7's own
    assert found.accepted.where("k = 7").first().v == 0


@pytest.mark.parametrize("repeat", [False, True])
def test_refresh_accounts_for_every_row(spark, small, tmp_path, repeat):
    raw = raw_tables(spark, small)
    if repeat:
        raw["clients"] = raw["clients"].unionByName(raw["clients"].withColumn("client_last_name", F.lit("Other")))
    layers = refresh.refresh_all(raw, str(tmp_path), bounds=BOUNDS, keep_rejects=True)
    assert set(layers["rejects"]) == set(layers["dds"]) == set(refresh.STAR_KEYS)
    for name in ("clients", *refresh.FACTS):
        assert layers["dds"][name].count() + layers["rejects"][name].count() == layers["ods"][name].count()
    for name in ("activity_types", "currencies", "payment_methods", "transaction_types"):
        assert layers["dds"][name].count() > 0 and RULE in layers["rejects"][name].columns
    repeated = layers["rejects"]["clients"].where(F.col(RULE) == "primary_key").count()
    assert (repeated > 0) == repeat
    if not repeat:
        plain = refresh.refresh_all(raw, str(tmp_path / "plain"), bounds=BOUNDS)
        for layer in ("dds", "dm"):
            for name, df in plain[layer].items():
                assert df.exceptAll(layers[layer][name].select(df.columns)).isEmpty()
                assert layers[layer][name].count() == df.count()
