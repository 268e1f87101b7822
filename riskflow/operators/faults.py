"""Planted defects, to test that cleaning and detectors find them.

Which rows are hit is a stable function of a row key: a run that is repeated hits the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# (row key, name of the defect, share of rows) -> condition
Picker = Callable[[Column, str, float], Column]
# The unbelievable years.
WRONG_YEARS = (1700, 1800, 2100, 2200)


def by_hash(key: Column, defect: str, share: float) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(defect)), F.lit(1_000_000)) < int(share * 1_000_000)


def _col(key: str | Column) -> Column:
    return F.col(key) if isinstance(key, str) else key


def blank_values(
    df: DataFrame, key: str | Column, columns: Sequence[str], share: float = 0.05, pick: Picker = by_hash
) -> DataFrame:
    """Null a share of the values of each column, independently per column."""
    key = _col(key)
    return df.withColumns({c: F.when(~pick(key, f"blank {c}", share), F.col(c)) for c in columns})


def wrong_dates(
    df: DataFrame,
    key: str | Column,
    column: str,
    share: float = 0.05,
    years: Sequence[int] = WRONG_YEARS,
    pick: Picker = by_hash,
    year_of: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Move a share of the dates to unbelievable years; ``year_of`` numbers the year to take per key."""
    key = _col(key)
    kind = df.schema[column].dataType
    number = year_of(key) if year_of else F.pmod(F.xxhash64(key, F.lit("year")), F.lit(len(years)))
    year = F.element_at(F.array(*[F.lit(y) for y in years]), number.cast("int") + 1)
    # day 28 at most, so that every month has it
    moved = F.make_date(year, F.month(column), F.least(F.dayofmonth(column), F.lit(28))).cast(kind)
    return df.withColumn(column, F.when(pick(key, "date", share), moved).otherwise(F.col(column)))


def repeat_rows(
    df: DataFrame, key: str | Column, share: float = 0.05, copies: int = 1, pick: Picker = by_hash
) -> DataFrame:
    """Repeat a share of the rows; the copies come out of one scan of the input."""
    times = F.when(pick(_col(key), "repeat", share), F.lit(copies)).otherwise(F.lit(0))
    return df.select("*", F.explode(F.sequence(F.lit(0), times)).alias("_copy")).drop("_copy")


def inflate_amounts(
    df: DataFrame, key: str | Column, column: str, share: float = 0.01, factor: int = 10, pick: Picker = by_hash
) -> DataFrame:
    """Multiply a share of the amounts."""
    larger = (F.col(column) * factor).cast(df.schema[column].dataType)
    return df.withColumn(column, F.when(pick(_col(key), "amount", share), larger).otherwise(F.col(column)))


def add_bursts(
    df: DataFrame, chosen: Column, times: int = 10, changes: Mapping[str, Callable[[Column], Column]] | None = None
) -> DataFrame:
    """Add ``times`` further rows at the same instant for each chosen row.

    ``changes`` gives columns of the added rows as a function of the 1-based position in the burst.
    """
    place = F.col("_place")
    count = F.when(chosen, F.lit(times)).otherwise(F.lit(0))
    rows = df.select("*", F.explode(F.sequence(F.lit(0), count)).alias("_place"))
    updates = {c: F.when(place > 0, change(place)).otherwise(F.col(c)) for c, change in (changes or {}).items()}
    return rows.withColumns(updates).drop("_place")


def shuffle_rows(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Spread rows evenly whatever their values; row order carries no meaning in a DataFrame."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n)
