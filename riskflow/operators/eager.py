"""Aggregates over many-to-many joins, computed without the joined rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def aggregate_fan_out(
    left: DataFrame,
    others: Sequence[DataFrame],
    key: str,
    by: Mapping[str, Column],
    counts: Mapping[str, Column],
    sums: Mapping[str, Column],
) -> DataFrame:
    """Counts and sums of columns of ``left`` over its inner join with all ``others`` on ``key``, per key and ``by``.

    A left row stands in the join once for each combination of rows of the others that share its key. So the left side
    is aggregated per key and ``by`` alone, each other side is counted per key, and counts and sums are multiplied: a
    key of n left and m right rows costs n + m rows, where the join has n x m. All aggregates combine before the
    shuffle, so a hot key needs no cutting. Sums keep their type's digits; pass decimals for exact results.
    """
    known = left.where(F.col(key).isNotNull())
    measures = [F.count(c).alias(n) for n, c in counts.items()] + [F.sum(c).alias(n) for n, c in sums.items()]
    out = known.groupBy(F.col(key), *[c.alias(n) for n, c in by.items()]).agg(*measures)
    for i, other in enumerate(others):
        per_key = other.where(F.col(key).isNotNull()).groupBy(F.col(key).alias(f"_key{i}")).agg(F.count(F.lit(1)).alias(f"_n{i}"))
        out = out.join(per_key, F.col(key) == F.col(f"_key{i}")).drop(f"_key{i}")
    for i in range(len(others)):
        out = out.withColumns({n: F.col(n) * F.col(f"_n{i}") for n in (*counts, *sums)}).drop(f"_n{i}")
    return out
