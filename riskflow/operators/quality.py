"""Key and constraint checks. Each returns rows (check, target, violations); zero violations is good."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _per_column(df: DataFrame, check: str, conditions: dict[str, Column]) -> DataFrame:
    # one scan and one result row for all columns, then one row per column
    counted = df.agg(*[F.count_if(cond).alias(c) for c, cond in conditions.items()])
    rows = F.array(*[F.struct(F.lit(c).alias("target"), F.col(c).alias("violations")) for c in conditions])
    return counted.select(F.explode(rows).alias("r")).select(F.lit(check).alias("check"), "r.target", "r.violations")


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows lacking a value, per column."""
    return _per_column(df, "not_null", {c: F.col(c).isNull() for c in columns})


def max_length(df: DataFrame, lengths: dict[str, int]) -> DataFrame:
    """Rows whose text is longer than allowed, per column."""
    return _per_column(df, "max_length", {c: F.length(c) > n for c, n in lengths.items()})


def primary_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of keys that occur more than once or hold a null."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return per_key.agg(F.count_if((F.col("n") > 1) | missing).alias("violations")).select(
        F.lit("primary_key").alias("check"), F.lit(",".join(keys)).alias("target"), "violations"
    )


def foreign_key(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Number of child rows whose key has no parent row; null keys refer to nothing and are fine.

    Child rows are counted per key before the join, so a hot key enters it as one row.
    """
    per_key = child.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    parents = parent.select(F.col(parent_key).alias("_parent"))
    orphans = per_key.join(parents, F.col("_key") == F.col("_parent"), "left_anti")
    return orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("violations")).select(
        F.lit("foreign_key").alias("check"), F.lit(key).alias("target"), "violations"
    )


def all_checks(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)
