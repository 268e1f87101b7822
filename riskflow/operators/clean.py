"""Row filters and deduplication."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.functions.text import lacks, not_named
from riskflow.schemas import NAME_TOKEN


def drop_missing_key(df: DataFrame, key: str) -> DataFrame:
    """Drop rows whose key is null or NaN."""
    return require(df, [key])


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep rows in which every listed column has a value; in floating columns NaN is no value.

    Written as plain null tests, which unlike ``dropna`` push down to the scan.
    """
    for c in columns:
        df = df.where(F.col(c).isNotNull())
        if df.schema[c].dataType.simpleString() in ("double", "float"):
            df = df.where(~F.isnan(c))
    return df


def require_names(df: DataFrame, columns: Sequence[str], token: str = NAME_TOKEN) -> DataFrame:
    """Keep rows whose names are present and free of the missing-value token."""
    for c in columns:
        df = df.where(lacks(c, token))
    return df


def exclude_names(df: DataFrame, column: str, names: Iterable[str]) -> DataFrame:
    """Drop rows whose name, in any case, is on the list or is null; also removes leaked header lines."""
    return df.where(not_named(column, names))


def in_range(df: DataFrame, column: str, bounds: tuple[str, str]) -> DataFrame:
    """Keep rows whose date lies within the inclusive bounds; the bounds are literals, so they push down."""
    kind = df.schema[column].dataType.simpleString()
    low, high = (F.lit(b).cast(kind) for b in bounds)
    return df.where(F.col(column).between(low, high))


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row deduplication. Copies collapse before the shuffle, so a huge group of copies is harmless."""
    return df.distinct()


def keep_one(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str] | None = None) -> DataFrame:
    """One row per key, the first by ``order`` and then by all remaining columns, so reruns agree.

    Catalyst turns the rank filter into a group limit on both sides of the shuffle: each task sends at
    most one row per key, whatever the size of a key.
    """
    key_columns = [F.col(k) if isinstance(k, str) else k for k in keys]
    first = list(order or [])
    plain_keys = {k for k in keys if isinstance(k, str)}
    rest = [c for c in df.columns if c not in plain_keys and c not in first]
    ranking = Window.partitionBy(*key_columns).orderBy(*[F.col(c).asc_nulls_first() for c in first + rest])
    return df.withColumn("_rank", F.row_number().over(ranking)).where("_rank = 1").drop("_rank")


def union_rows(*parts: DataFrame) -> DataFrame:
    """Bag union by column name."""
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole


def preview(df: DataFrame, order: Sequence[str], n: int = 10) -> DataFrame:
    """The first ``n`` rows by ``order``; each task keeps at most ``n`` rows."""
    return df.orderBy(*order).limit(n)
