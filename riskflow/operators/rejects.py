"""Loads that keep what they refuse: every row is accepted or rejected with the name of the rule it breaks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.session import materialize

#: the column of rejected rows that names the broken rule
RULE = "broken_rule"


@dataclass(frozen=True)
class Rule:
    """Rows for which ``broken`` is true break the rule; null counts as kept."""

    name: str
    broken: Column


def not_null(columns: Sequence[str]) -> list[Rule]:
    return [Rule(f"not_null:{c}", F.col(c).isNull()) for c in columns]


def max_length(lengths: Mapping[str, int]) -> list[Rule]:
    return [Rule(f"max_length:{c}", F.length(c) > n) for c, n in lengths.items()]


def in_range(column: str, bounds: tuple[str, str], kind: str) -> list[Rule]:
    """A missing date lies in no range."""
    low, high = (F.lit(b).cast(kind) for b in bounds)
    return [Rule(f"date_range:{column}", ~F.coalesce(F.col(column).between(low, high), F.lit(False)))]


@dataclass(frozen=True)
class Known:
    """Rows must hold in ``column`` one of the (distinct) values of ``names``'s column ``name``."""

    column: str
    names: DataFrame
    name: str


@dataclass(frozen=True)
class Judged:
    accepted: DataFrame
    rejected: DataFrame


def judge(
    df: DataFrame,
    rules: Sequence[Rule],
    known: Sequence[Known] = (),
    key: Sequence[str] = (),
    order: Sequence[str | Column] = (),
) -> Judged:
    """Split distinct rows into accepted and rejected ones; each rejected row has the first rule that it breaks.

    Order of rules: ``rules``, then ``known:<column>``, then ``primary_key``: of the rows of one ``key`` that break no
    other rule, the first by ``order`` and all remaining columns (nulls first) is accepted. The first row of a key is
    an aggregate that combines before the shuffle and is joined back, so a hot key is never in one task. The judged
    rows are written once; both parts read what is written.
    """
    marked = df
    broken: list[tuple[str, Column]] = [(r.name, r.broken) for r in rules]
    for i, k in enumerate(known):
        names = k.names.select(F.col(k.name).alias(f"_name{i}"), F.lit(True).alias(f"_known{i}"))
        marked = marked.join(names, F.col(k.column) == F.col(f"_name{i}"), "left").drop(f"_name{i}")
        broken.append((f"known:{k.column}", F.col(f"_known{i}").isNull()))
    first = F.coalesce(*[F.when(b, F.lit(n)) for n, b in broken]) if broken else F.lit(None).cast("string")
    marked = marked.withColumn(RULE, first).drop(*[f"_known{i}" for i in range(len(known))])
    if key:
        named = {c for c in order if isinstance(c, str)} | set(key)
        place = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order], *[F.col(c) for c in df.columns if c not in named])
        passing = marked.where(F.col(RULE).isNull())
        firsts = passing.groupBy(*[F.col(c).alias(f"_{c}") for c in key]).agg(F.min(place).alias("_first"))
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key]
        joined = marked.join(firsts, [*same, F.col(RULE).isNull()], "left")
        repeated = F.col(RULE).isNull() & ~place.eqNullSafe(F.col("_first"))
        marked = joined.withColumn(RULE, F.when(repeated, F.lit("primary_key")).otherwise(F.col(RULE)))
        marked = marked.drop("_first", *[f"_{c}" for c in key])
    stored = materialize(marked, "judged")
    return Judged(stored.where(F.col(RULE).isNull()).drop(RULE), stored.where(F.col(RULE).isNotNull()))


def unusable_names(df: DataFrame, column: str, usable: DataFrame, name: str) -> DataFrame:
    """The distinct values of ``column`` that a dimension leaves out; null is one of them."""
    values = df.select(column).distinct()
    left_out = values.join(usable, F.col(column) == F.col(name), "left_anti")
    return left_out.withColumn(RULE, F.lit(f"name:{column}"))


def reject_counts(rejects: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, broken_rule, rows): how many rows of each table broke each rule."""
    parts = [df.groupBy(RULE).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), RULE, "rows") for n, df in rejects.items()]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionAll(part)
    return whole
