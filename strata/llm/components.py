"""Connected components by distributed union-find, in DataFrame operations only.

Each round every node points at its smallest neighbour (or itself), both ends
of each edge are replaced by what they point at, and edges that became loops
are gone. A component keeps its smallest node throughout and at least halves
its other nodes, so the rounds grow with the logarithm of the largest
component. A star collapses in one round. The pointers of each round are
written to the shared checkpoint folder, so no round recomputes another.

A hub with very many edges costs one row per task in the pointer aggregate
(map-side combine); the two joins are plain equi-joins that Spark may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import stage


def _ordered(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Edges without loops and repeats, smaller end first."""
    return (edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
            .where("a < b").distinct())


def connected(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``node, component`` for every end of ``edges`` (columns ``a``, ``b`` of
    one orderable type); ``component`` is the smallest node reachable. Edges
    with a null end are ignored. Runs jobs."""
    edges = stage(spark, _ordered(edges.where("a is not null and b is not null"), "a", "b"),
                  "edges")
    labels = None
    while not edges.isEmpty():
        ends = edges.union(edges.select("b", "a"))
        up = stage(spark, ends.groupBy("a").agg(F.min("b").alias("m"))
                   .select(F.col("a").alias("node"), F.least("a", "m").alias("up")), "pointers")
        labels = up if labels is None else stage(spark, (
            labels.join(up.select(F.col("node").alias("up"), F.col("up").alias("next")), "up", "left")
            .select("node", F.coalesce("next", "up").alias("up"))), "labels")
        first = up.select(F.col("node").alias("a"), F.col("up").alias("up_a"))
        second = up.select(F.col("node").alias("b"), F.col("up").alias("up_b"))
        edges = stage(spark, _ordered(edges.join(first, "a").join(second, "b"), "up_a", "up_b"),
                      "edges")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels.select("node", F.col("up").alias("component"))
