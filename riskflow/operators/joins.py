"""Inner equi joins on a key that may be hot on one or both sides."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.session import materialize


@dataclass(frozen=True)
class Splits:
    """How hot keys are cut.

    A key of n left and m right rows gives n * m rows. It is cut into a grid whose cells give at most about
    ``output_per_task`` rows and read at most ``rows_per_task`` rows of a side. Every key above these sizes is cut.
    The numbers steer only the placement of rows, never the result.
    """

    rows_per_task: int = 5_000_000
    output_per_task: int = 25_000_000


def hot_pieces(left: DataFrame, right: DataFrame, key: str, splits: Splits = Splits()) -> DataFrame:
    """(key, left_pieces, right_pieces) of every key that must be cut, from exact counts of both sides.

    Counts combine before the shuffle and have one row per key, whatever the number of rows of a key.
    """
    n = left.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").cast("double").alias("_n"))
    m = right.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").cast("double").alias("_m"))

    def pieces(own: str, other: str) -> Column:
        # as many rows of a side as its partner's rows allow; a square cell where both sides are long
        allowed = F.greatest(F.lit(sqrt(splits.output_per_task)), F.lit(float(splits.output_per_task)) / F.col(other))
        return F.ceil(F.col(own) / F.least(F.lit(float(splits.rows_per_task)), allowed)).cast("int")

    found = n.join(m, key).select(key, pieces("_n", "_m").alias("left_pieces"), pieces("_m", "_n").alias("right_pieces"))
    return found.where("left_pieces > 1 or right_pieces > 1")


def hot_left_pieces(left: DataFrame, key: str, splits: Splits = Splits()) -> DataFrame:
    """As ``hot_pieces`` for a right side that is unique on the key: only the left rows decide, and only they are counted."""
    n = left.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    most = min(splits.rows_per_task, splits.output_per_task)
    many = n.where(F.col("_n") > most)
    return many.select(key, F.ceil(F.col("_n") / most).cast("int").alias("left_pieces"), F.lit(1).alias("right_pieces"))


def _spread(columns: Sequence[str], pieces: str) -> Column:
    # a hash of row values, not a random number: a task that is run again places its rows as before
    return F.pmod(F.xxhash64(*columns), F.col(pieces)).cast("int")


def _copies(pieces: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(pieces) - 1))


def _with_pieces(df: DataFrame, pieces: DataFrame, key: str) -> DataFrame:
    found = pieces.select(F.col(key).alias("_key"), F.col("left_pieces").alias("_ls"), F.col("right_pieces").alias("_rs"))
    counted = df.join(found, F.col(key) == F.col("_key"), "left").drop("_key")
    return counted.withColumns({c: F.coalesce(c, F.lit(1)) for c in ("_ls", "_rs")})


def fan_out_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_spread: Sequence[str],
    right_spread: Sequence[str],
    lookups: Sequence[DataFrame] = (),
    splits: Splits = Splits(),
) -> DataFrame:
    """Many-to-many inner join on ``key``, with one-to-many ``lookups`` on the same key in between.

    A hot key becomes a grid: its left rows are cut into pieces by a hash of ``left_spread`` and its right rows by a
    hash of ``right_spread``, and every pair of pieces meets in one task. All other keys keep one piece. Each input is
    shuffled once on (key, piece, piece), which serves all joins, and merged, since a broadcast would leave the rows
    of a hot key together. Without hot keys it is a plain join and Catalyst picks its way. ``lookups`` must be unique
    on the key. Both inputs are counted per key first, so pass stored tables.
    """
    return _grid_join(left, right, key, hot_pieces(left, right, key, splits), left_spread, right_spread, lookups)


def _grid_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    pieces: DataFrame,
    left_spread: Sequence[str],
    right_spread: Sequence[str],
    lookups: Sequence[DataFrame] = (),
) -> DataFrame:
    if pieces.isEmpty():  # nothing is written then
        for side in lookups:
            left = left.join(side, key)
        return left.join(right, key)

    pieces = materialize(pieces, "pieces")
    keys = [key, "_lp", "_rp"]
    grid = _with_pieces(left, pieces, key).withColumn("_lp", _spread(left_spread, "_ls")).withColumn("_rp", _copies("_rs"))
    joined = grid.drop("_ls", "_rs")
    for side in lookups:
        every_left = _with_pieces(side, pieces, key).withColumn("_lp", _copies("_ls"))
        joined = joined.join(every_left.withColumn("_rp", _copies("_rs")).drop("_ls", "_rs").hint("merge"), keys)
    every_left = _with_pieces(right, pieces, key).withColumn("_lp", _copies("_ls"))
    other = every_left.withColumn("_rp", _spread(right_spread, "_rs")).drop("_ls", "_rs")
    return joined.join(other.hint("merge"), keys).drop("_lp", "_rp")


def unique_join(
    left: DataFrame, right: DataFrame, key: str, left_spread: Sequence[str], splits: Splits = Splits()
) -> DataFrame:
    """Inner join with a right side that is unique on ``key``; left rows of hot keys are cut into pieces."""
    return _grid_join(left, right, key, hot_left_pieces(left, key, splits), left_spread, [key])
