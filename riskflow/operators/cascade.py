"""Deletes that follow references: rows whose parent goes, go as well."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.session import materialize


@dataclass(frozen=True)
class Reference:
    """Column ``column`` of table ``child`` names a row of ``parent`` by its ``key``."""

    child: str
    column: str
    parent: str
    key: str


@dataclass(frozen=True)
class Cascade:
    """What a delete leaves of each table, and what it takes."""

    left: dict[str, DataFrame]
    removed: dict[str, DataFrame]


def parents_first(tables: Sequence[str], references: Sequence[Reference]) -> tuple[list[str], bool]:
    """The tables so that parents precede their children, and whether references run in a circle.

    Within a circle the given order stands.
    """
    order: list[str] = []
    waiting = list(tables)
    while waiting:
        ready = [t for t in waiting if not any(r.child == t and r.parent in waiting for r in references)]
        if not ready:
            return order + waiting, True
        order += ready
        waiting = [t for t in waiting if t not in ready]
    return order, False


def _marked(df: DataFrame, marks: Sequence[tuple[list[tuple[str, str]], DataFrame]]) -> DataFrame:
    """``df`` with ``_gone``, true where the named columns of a row are among the (distinct) keys of any mark."""
    gone: Column = F.lit(False)
    for i, (pairs, keys) in enumerate(marks):
        found = keys.select(*[F.col(key).alias(f"_key{i}_{n}") for n, (_, key) in enumerate(pairs)], F.lit(True).alias(f"_mark{i}"))
        same = [F.col(column) == F.col(f"_key{i}_{n}") for n, (column, _) in enumerate(pairs)]
        df = df.join(found, same, "left").drop(*[f"_key{i}_{n}" for n in range(len(pairs))])
        gone |= F.coalesce(f"_mark{i}", F.lit(False))
    return df.withColumn("_gone", gone).drop(*[f"_mark{i}" for i in range(len(marks))])


def cascade_delete(
    tables: Mapping[str, DataFrame], references: Sequence[Reference], doomed: Mapping[str, DataFrame]
) -> Cascade:
    """Delete the rows named by ``doomed`` and all rows that refer to a deleted row, over any number of tables.

    ``doomed`` maps a table to a table of keys: rows equal to one in all its columns go. Null refers to nothing. Each
    table is read once, parents before children, with all its references at a time, and written once with a mark.
    The keys that go are distinct, so a hot parent enters as one row, and the join of a hot child key is cut by the
    adaptive skew join, since only its left side is large. References that run in a circle, or within a table, are
    followed in rounds until no further row goes; their number grows with the longest chain.

    Tables that nothing touches are returned as they are.
    """
    order, circular = parents_first(list(tables), references)
    marked: dict[str, DataFrame] = {}
    gone_before = None
    while True:
        for name in order:
            marks = []
            if name in doomed:
                marks.append(([(c, c) for c in doomed[name].columns], doomed[name].distinct()))
            for r in references:
                if r.child == name and r.parent in marked:
                    keys = marked[r.parent].where("_gone").select(r.key).where(F.col(r.key).isNotNull()).distinct()
                    marks.append(([(r.column, r.key)], keys))
            if marks:
                marked[name] = materialize(_marked(tables[name], marks), name)
        if not circular:
            break
        gone = sum(df.where("_gone").count() for df in marked.values())
        if gone == gone_before:
            break
        gone_before = gone
    left = {n: marked[n].where("not _gone").drop("_gone") if n in marked else df for n, df in tables.items()}
    removed = {n: marked[n].where("_gone").drop("_gone") if n in marked else df.limit(0) for n, df in tables.items()}
    return Cascade(left, removed)


def delete_counts(done: Cascade) -> DataFrame:
    """(table_name, rows_left, rows_removed), a row per table."""
    rows = []
    for name, left in done.left.items():
        both = left.select(F.lit(1).alias("l"), F.lit(0).alias("r")).unionAll(done.removed[name].select(F.lit(0).alias("l"), F.lit(1).alias("r")))
        sums = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(n) for c, n in (("l", "rows_left"), ("r", "rows_removed"))]
        rows.append(both.agg(*sums).select(F.lit(name).alias("table_name"), "rows_left", "rows_removed"))
    whole = rows[0]
    for row in rows[1:]:
        whole = whole.unionAll(row)
    return whole
