"""Deletes along references: chains, several parents, circles, nulls and hot parents."""

from __future__ import annotations

import pytest

from checks.standins import ORDER_BOUNDS, raw_tables
from riskflow.operators.cascade import Reference, cascade_delete, delete_counts, parents_first
from riskflow.plans import refresh
from riskflow.sources import readers, versions


def tables(spark, **rows):
    return {name: spark.createDataFrame(data, schema) for name, (schema, data) in rows.items()}


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def keys(spark, *values, name="id"):
    return spark.createDataFrame([(v,) for v in values], f"{name} long")


def test_chain_and_two_parents(spark):
    given = tables(
        spark,
        leaf=("id long, b long, c long", [(1, 1, 9), (2, 2, 9), (3, 3, 8), (4, None, None), (5, 3, None), (6, 77, 9)]),
        b=("id long, a long", [(1, 1), (2, 1), (3, 2), (4, None)]),
        a=("id long", [(1,), (2,), (3,)]),
        c=("id long", [(8,), (9,)]),
        apart=("id long", [(1,), (2,)]),
    )
    links = [Reference("leaf", "b", "b", "id"), Reference("b", "a", "a", "id"), Reference("leaf", "c", "c", "id")]
    done = cascade_delete(given, links, {"a": keys(spark, 1, 1, 42, None), "c": keys(spark, 8)})
    assert {n: ids(df) for n, df in done.left.items()} == {"leaf": [4, 5, 6], "b": [3, 4], "a": [2, 3], "c": [9], "apart": [1, 2]}
    assert {n: ids(df) for n, df in done.removed.items()} == {"leaf": [1, 2, 3], "b": [1, 2], "a": [1], "c": [8], "apart": []}
    assert done.left["apart"] is given["apart"]
    counts = {r.table_name: (r.rows_left, r.rows_removed) for r in delete_counts(done).collect()}
    assert counts == {"leaf": (3, 3), "b": (2, 2), "a": (2, 1), "c": (1, 1), "apart": (2, 0)}
    for name, df in given.items():
        assert done.left[name].unionByName(done.removed[name]).exceptAll(df).isEmpty()


def test_references_within_a_table_and_in_a_circle(spark):
    links = [Reference("t", "up", "t", "id"), Reference("t", "u", "u", "id"), Reference("u", "t", "t", "id")]
    assert parents_first(["t", "u", "v"], links) == (["v", "t", "u"], True)
    given = tables(
        spark,
        t=("id long, up long, u long", [(1, None, None), (2, 1, None), (3, 2, None), (4, 3, None), (5, None, 10), (6, 5, None), (7, 7, None), (8, None, 11)]),
        u=("id long, t long", [(10, 4), (11, 8), (12, None)]),
    )
    done = cascade_delete(given, links, {"t": keys(spark, 2)})
    assert ids(done.left["t"]) == [1, 7, 8] and ids(done.left["u"]) == [11, 12]


def test_a_hot_parent_and_no_rows(spark):
    rows = spark.range(30_000).selectExpr("id", "if(id % 3 = 0, 1L, id) AS parent")
    given = {"p": spark.range(30_000).select("id"), "k": rows}
    done = cascade_delete(given, [Reference("k", "parent", "p", "id")], {"p": keys(spark, 1, 4)})
    assert done.removed["k"].count() == 10_000 + 2 and done.left["k"].count() == 20_000 - 2
    empty = cascade_delete({n: df.limit(0) for n, df in given.items()}, [Reference("k", "parent", "p", "id")], {"p": keys(spark, 1)})
    assert empty.left["k"].count() == 0
    untouched = cascade_delete(given, [Reference("k", "parent", "p", "id")], {"p": keys(spark)})
    assert untouched.left["k"].count() == 30_000


def test_deleting_from_the_stored_star(spark, small, tmp_path):
    bounds = {"logins": ORDER_BOUNDS, "transactions": ORDER_BOUNDS}
    star = refresh.refresh_dds(refresh.refresh_ods(raw_tables(spark, small), str(tmp_path)), str(tmp_path), bounds)
    before = {n: df.count() for n, df in star.items()}
    gone = star["clients"].limit(3).select("client_id")
    after, done = refresh.delete_from_star(star, str(tmp_path), {"clients": gone})
    assert after["clients"].count() == before["clients"] - 3
    assert {n: done.left[n].count() + done.removed[n].count() for n in star} == before
    checks = refresh.star_checks(after).where("check = 'foreign_key'").collect()
    orphans = refresh.star_checks(star).where("check = 'foreign_key'").collect()
    assert {r.target: r.violations for r in checks} == {r.target: r.violations for r in orphans}
    stored = readers.read_table(spark, f"{tmp_path}/dds/clients")
    assert stored.count() == after["clients"].count()
    assert versions.current(spark, f"{tmp_path}/dds/clients").number == 2
    assert versions.current(spark, f"{tmp_path}/dds/currencies").number == 1


@pytest.mark.parametrize("repeated", [False, True])
def test_keys_of_several_columns(spark, repeated):
    rows = [(1, "a"), (1, "b"), (2, "a"), (None, "a")] * (2 if repeated else 1)
    given = {"t": spark.createDataFrame(rows, "id long, name string")}
    done = cascade_delete(given, [], {"t": spark.createDataFrame([(1, "a"), (None, "a")], "id long, name string")})
    assert done.removed["t"].distinct().count() == 1 and done.left["t"].distinct().count() == 3
