"""Connected components of an edge table, by joins and grouping only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.session import discard, materialize, shuffles_released


def is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether every ``hi`` has one edge and is no edge's ``lo``, so that ``lo`` is the root of its star."""
    ends = edges.select(F.col("hi").alias("node"), F.lit(1).alias("up")).unionByName(edges.select(F.col("lo").alias("node"), F.lit(0).alias("up")))
    ends = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    with shuffles_released(edges.sparkSession):
        return not ends.where("ups > 1 or (ups > 0 and least = 0)").agg(F.count("*")).first()[0]


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component_id) of every id on an edge; component_id is the smallest id reachable.

    Alternates two steps until the edges are stars: every neighbour above a node is attached to the node's smallest
    neighbour, then every neighbour below it is. Edges that are stars already, as those of an earlier result, take no
    step. Each step is one grouping and one join, the number of rounds grows with the logarithm of the longest path, and
    each round is written to the shared folder in place of the one before, so lineage stays short.
    A node of high degree is pre-aggregated by the grouping and split by the adaptive skew join. Nulls, loops and
    repeated edges are left out; no edges give an empty table.
    """
    x, y = F.col(a).cast("long"), F.col(b).cast("long")
    now = (
        edges.select(F.greatest(x, y).alias("hi"), F.least(x, y).alias("lo"), x.alias("x"), y.alias("y"))
        .where("x is not null and y is not null and hi > lo")
        .select("hi", "lo")
        .distinct()
    )
    now = materialize(now, "edges")
    while not is_forest_of_stars(now):
        both = now.unionByName(now.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy(F.col("hi").alias("node")).agg(F.least(F.min("lo"), F.max("hi")).alias("m"))
        large = (
            both.where("lo > hi")
            .join(least, F.col("hi") == F.col("node"))
            .select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            .where("hi > lo")
        )
        large = large.distinct()
        below = large.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("m"))
        small = (
            large.join(below, F.col("hi") == F.col("node"))
            .select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            .where("hi > lo")
            .unionByName(below.select(F.col("node").alias("hi"), F.col("m").alias("lo")))
            .distinct()
        )
        last, now = now, materialize(small, "edges")
        discard(last)
    roots = now.select(F.col("lo").alias("id"), F.col("lo").alias("component_id")).distinct()
    return now.select(F.col("hi").alias("id"), F.col("lo").alias("component_id")).unionByName(roots)
