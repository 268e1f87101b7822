"""Dimensions: distinct names with dense surrogate keys, and their lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskflow.operators.clean import exclude_names
from riskflow.schemas import NULL_TOKENS
from riskflow.session import materialize


def dimension_names(df: DataFrame, column: str, name: str, header: str | None = None) -> DataFrame:
    """The distinct usable names of one column; leaked header texts and missing-value texts are left out."""
    names = exclude_names(df.select(column), column, (*NULL_TOKENS, header or column))
    return names.distinct().select(F.col(column).alias(name))


def number_rows(df: DataFrame, order: Sequence[str], key: str) -> DataFrame:
    """Add a dense 1-based ``key`` in the order of the (unique) ``order`` columns of a stored table.

    The table is sorted into ranges, written, and each row gets its position within its range plus the size of
    the ranges before it; no task holds more than one range.
    """
    ranges = df.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    placed = materialize(
        ranges.select(
            *df.columns,
            F.shiftright(place, 33).cast("int").alias("_range"),
            place.bitwiseAND(F.lit((1 << 33) - 1)).alias("_within"),
        ),
        "ranges",
    )
    sizes = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    # one row per range, and there are no more ranges than shuffle partitions
    numbered = placed.join(F.broadcast(starts), "_range")
    return numbered.select((F.col("_start") + F.col("_within") + 1).cast("int").alias(key), *df.columns)


def build_dim(df: DataFrame, column: str, key: str, name: str, header: str | None = None) -> DataFrame:
    """A dimension table (key, name) of one text column.

    The distinct names are written before they are numbered and looked up: the source is scanned once, and
    Catalyst broadcasts the dimension in lookups exactly while its file size allows it.
    """
    names = materialize(dimension_names(df, column, name, header), name)
    return number_rows(names, [name], key)


def lookup(fact: DataFrame, dim: DataFrame, column: str, key: str, name: str) -> DataFrame:
    """Replace the name in ``column`` by the dimension's key; names outside the dimension drop the row."""
    # the renamed key shields the fact's own column of the same name
    found = dim.select(F.col(key).alias("_key"), F.col(name).alias("_name"))
    joined = fact.join(found, F.col(column) == F.col("_name"), "inner")
    return joined.withColumn(column, F.col("_key")).drop("_key", "_name")
