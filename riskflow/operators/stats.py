"""Statistics over a whole table or per group, without holding a group in one task."""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction
from functools import reduce
from math import floor
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def mean_and_deviation(columns: dict[str, Column]) -> list[Column]:
    """avg_<name> and stddev_<name> (sample) for each measure; a single row has no deviation."""
    out = []
    for name, c in columns.items():
        out += [F.avg(c).cast("double").alias(f"avg_{name}"), F.stddev_samp(c.cast("double")).alias(f"stddev_{name}")]
    return out


def with_day_stats(df: DataFrame, day: str, measures: dict[str, Column]) -> DataFrame:
    """Add the mean and sample deviation of each measure over all rows of the same day.

    Equal to a window over the day, but a window would bring a whole day into one task. Here days are
    aggregated before the shuffle and the result is joined back. It may be broadcast whatever the data size:
    a date column holds at most 3 652 059 different days (years 1 to 9999), about 150 MB of statistics. Any other
    type is refused.
    """
    if df.schema[day].dataType != T.DateType():
        raise TypeError(f"{day} must be a date")
    stats = df.groupBy(F.col(day).alias("_day")).agg(*mean_and_deviation(measures))
    joined = df.join(F.broadcast(stats), F.col(day) == F.col("_day"))
    return joined.drop("_day")


class Gap(NamedTuple):
    """The rows of a column strictly between two values; an end of None is open."""

    column: str
    low: float | None
    high: float | None
    before: int  # rows up to the low end
    rows: int

    def holds(self) -> Column:
        c = F.col(self.column)
        inside = c.isNotNull()
        if self.low is not None:
            inside &= c > self.low
        if self.high is not None:
            inside &= c < self.high
        return inside


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    accuracy: int = 100_000,
    task_rows: int = 1_000_000,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles per column, exact and in bounded memory.

    Each wanted rank lies in a gap, at first the whole column. While a gap has more than ``task_rows`` rows, a sketch
    gives cut values close below and above the rank, and the rows below and up to each cut value are counted exactly:
    the rank falls on a cut value or into a gap of a few ``accuracy``-ths of the rows. What is left is ordered, no more
    than ``task_rows`` rows of a gap in a task. Sizes decide the number of rounds, never the result.

    Each pass gives one row of fixed width to the driver; pass a written table.
    """
    values = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    totals = values.agg(*[F.count(c).alias(c) for c in columns]).first().asDict()
    places: dict[str, list[tuple[int, float]]] = {}
    known: dict[tuple[str, int], float] = {}
    gaps: dict[Gap, set[int]] = {}
    for c in columns:
        total = totals[c]
        ranks = [Fraction(p).limit_denominator(10**9) * (total - 1) for p in probabilities] if total else []
        places[c] = [(floor(r), float(r - floor(r))) for r in ranks]
        if total:
            gaps[Gap(c, None, None, 0, total)] = {r for low, _ in places[c] for r in (low, min(low + 1, total - 1))}
    while wide := {gap: ranks for gap, ranks in gaps.items() if gap.rows > task_rows}:
        narrow, found = _narrowed(values, wide, accuracy)
        gaps = {gap: ranks for gap, ranks in gaps.items() if gap not in wide} | narrow
        known |= found
    if gaps:
        known |= _ordered_ranks(values, gaps)

    result: dict[str, list[float | None]] = {c: [None] * len(probabilities) for c in columns}
    for c in columns:
        for i, (low, part) in enumerate(places[c]):
            at = known[c, low]
            result[c][i] = at + part * (known.get((c, low + 1), at) - at)
    return result


def _narrowed(
    values: DataFrame, gaps: dict[Gap, set[int]], accuracy: int
) -> tuple[dict[Gap, set[int]], dict[tuple[str, int], float]]:
    """Narrower gaps around the wanted ranks, and the ranks that fall on a cut value.

    A cut value is one of the gap's own values, so every round leaves smaller gaps.
    """
    margin = 2.0 / accuracy
    sketches = []
    for g, (gap, ranks) in enumerate(gaps.items()):
        near = {min(max((r - gap.before) / gap.rows + d, 0.0), 1.0) for r in ranks for d in (-margin, margin)}
        inside = F.when(gap.holds(), F.col(gap.column))
        sketches.append(F.percentile_approx(inside, sorted(near), accuracy).alias(f"{g}"))
    sketch = values.agg(*sketches).first()
    # NaN is the largest value
    cuts = [sorted(set(sketch[str(g)]), key=lambda v: (v != v, v)) for g in range(len(gaps))]
    tallies = []
    for g, gap in enumerate(gaps):
        for i, cut in enumerate(cuts[g]):
            tallies.append(F.count_if(gap.holds() & (F.col(gap.column) < cut)).alias(f"{g}.below.{i}"))
            tallies.append(F.count_if(gap.holds() & (F.col(gap.column) <= cut)).alias(f"{g}.upto.{i}"))
    counted = values.agg(*tallies).first().asDict()

    narrow: dict[Gap, set[int]] = {}
    known: dict[tuple[str, int], float] = {}
    for g, (gap, ranks) in enumerate(gaps.items()):
        for rank in ranks:
            low, before = gap.low, gap.before
            for i, cut in enumerate(cuts[g]):
                below = gap.before + counted[f"{g}.below.{i}"]
                if rank < below:
                    narrow.setdefault(Gap(gap.column, low, cut, before, below - before), set()).add(rank)
                    break
                low, before = cut, gap.before + counted[f"{g}.upto.{i}"]
                if rank < before:
                    known[gap.column, rank] = cut
                    break
            else:
                rest = gap.before + gap.rows - before
                narrow.setdefault(Gap(gap.column, low, gap.high, before, rest), set()).add(rank)
    return narrow, known


def _ordered_ranks(values: DataFrame, gaps: dict[Gap, set[int]]) -> dict[tuple[str, int], float]:
    """The values at the wanted ranks within narrow gaps of the columns, ordered one gap per task."""
    inside = [gap.holds() for gap in gaps]
    entries = [
        F.when(within, F.struct(F.lit(g).alias("gap"), F.col(gap.column).alias("v")))
        for g, (within, gap) in enumerate(zip(inside, gaps))
    ]
    rows = values.where(reduce(or_, inside)).select(F.explode(F.array_compact(F.array(*entries))).alias("e"))
    tallied = rows.groupBy("e.gap", "e.v").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("gap").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = tallied.select("gap", "v", F.sum("n").over(order).alias("upto"))
    wanted = [(g, gap, rank) for g, (gap, ranks) in enumerate(gaps.items()) for rank in ranks]
    picked = [
        F.min(F.when((F.col("gap") == g) & (F.col("upto") > rank - gap.before), F.col("v"))).alias(f"{g}.{rank}")
        for g, gap, rank in wanted
    ]
    found = ranked.agg(*picked).first()
    return {(gap.column, rank): found[f"{g}.{rank}"] for g, gap, rank in wanted}


def smallest_hashes(df: DataFrame, column: str, key: Sequence[str], size: int) -> DataFrame:
    """(hash, value) of the ``size`` rows with a value in ``column`` whose hashed ``key`` is smallest.

    The hash is the md5 text of the key's columns joined by ``|``, so the sample depends on the rows alone, not on their
    order or place, and it can be repeated in SQL. Samples merge: the smallest of two tables' samples are the sample of
    both (``merged_hashes``). The known number of rows gives a bound that about twice ``size`` hashes stay below, so
    tasks send few rows on; should fewer than ``size`` be below it, it is raised.
    """
    hashed = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key]).cast("binary"))
    rows = df.where(F.col(column).isNotNull()).select(hashed.alias("hash"), F.col(column).cast("double").alias("value"))
    total = rows.count()
    share = min(1.0, 2.0 * size / total) if total else 1.0
    while True:
        # 13 digits of a hash hold 52 bits
        near = rows if share >= 1 else rows.where(F.substring("hash", 1, 13) < f"{int(share * 16**13):013x}")
        if share >= 1 or near.count() >= size:
            return near.orderBy("hash", "value").limit(size)
        share = min(1.0, share * 2)


def merged_hashes(samples: Sequence[DataFrame], size: int) -> DataFrame:
    """The sample of all rows from samples of parts of them."""
    return reduce(DataFrame.unionByName, samples).orderBy("hash", "value").limit(size)


def sampled_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], key: Sequence[str], size: int = 8192
) -> dict[str, list[float | None]]:
    """Interpolated quantiles per column of a sample of fixed size, the rows of smallest hashes; few passes.

    Exact while a column has at most ``size`` values. Beyond that the rank of a result is off by about
    sqrt(p (1 - p) / size) of the rows (0.5 % at a quartile and the default size). The driver gets ``size`` numbers.
    """
    found: dict[str, list[float | None]] = {}
    for c in columns:
        held = sorted((r.value for r in smallest_hashes(df, c, key, size).collect()), key=lambda v: (v != v, v))
        found[c] = []
        for p in probabilities:
            at = p * (len(held) - 1)
            low = floor(at)
            high = min(low + 1, len(held) - 1)
            found[c].append(held[low] + (at - low) * (held[high] - held[low]) if held else None)
    return found


def approx_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], accuracy: int = 100_000
) -> dict[str, list[float | None]]:
    """As ``exact_quantiles``, by one sketch pass: actual values within 1/accuracy of the wanted rank."""
    sketch = [F.percentile_approx(F.col(c).cast("double"), list(probabilities), accuracy).alias(c) for c in columns]
    row = df.agg(*sketch).first()
    return {c: row[c] or [None] * len(probabilities) for c in columns}
