"""Connected components by alternating large-star and small-star steps.

Every step is a grouped minimum (combined map-side) and an equi-join that adaptive execution
can split on a hot node; the edges of a step are stored in the shared folder, so a lost
executor costs one step. The driver sees one flag a round, never edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.llm.common import materialize


def _stars(edges: DataFrame) -> bool:
    """Whether every node either points to one smaller node or is only pointed to."""
    ends = edges.select("a", F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        edges.select(F.col("b").alias("a"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    nodes = ends.groupBy("a").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return nodes.where("out > 1 or (out = 1 and into = 1)").isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, component) for every node of an edge; component is its least node id."""
    edges = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    edges = materialize(edges.where("a <> b").distinct(), "edges")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").select(F.explode(F.array(F.col("a"), F.col("b"))).alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        edges = materialize(small, "edges")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots).distinct()
