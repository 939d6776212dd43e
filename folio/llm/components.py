"""Connected components of an edge table by alternating large-star and small-star steps.

Nothing is collected: a step is one minimum per node and one join, until all are stars. Hot nodes only meet in
the partial minimum, and Spark splits their side of the join. Each step's edges are
written to the shared checkpoint folder, which cuts the lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.common import materialize, partitions


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least of its neighbourhood."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("n"), F.least("a", "least").alias("least"))
    return both.filter("b > a").join(least, F.col("a") == F.col("n")).select(F.col("least").alias("a"), "b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is tied to the least of them."""
    down = edges.select(F.col("b").alias("n"), F.col("a").alias("low"))  # low < n
    least = down.groupBy("n").agg(F.min("low").alias("least")).select(F.col("n").alias("m"), "least")
    tied = down.join(least, F.col("n") == F.col("m")).select(F.col("least").alias("a"), F.col("low").alias("b")).filter("a < b")
    return tied.unionByName(least.select(F.col("least").alias("a"), F.col("m").alias("b"))).distinct()


def _stars(edges: DataFrame) -> bool:
    """Is every larger end tied once, and to a node that is nowhere the larger end? Then each
    component is a star around its least node, and another round would change nothing."""
    ends = edges.select(F.col("b").alias("node"), F.lit(1).alias("ties"), F.lit(0).alias("center"))
    ends = ends.unionByName(edges.select(F.col("a").alias("node"), F.lit(0).alias("ties"), F.lit(1).alias("center")))
    nodes = ends.groupBy("node").agg(F.sum("ties").alias("ties"), F.max("center").alias("center"))
    return nodes.filter("ties > 1 or ties = 1 and center = 1").agg(F.count(F.lit(1))).first()[0] == 0


def _written(edges: DataFrame) -> DataFrame:
    """A step's edges in few files: two numbers a row need an eighth of the shuffle's tasks, or
    one a core if that is more, and each file costs an executor some system processes where
    Hadoop has no native library. What lies before the last exchange keeps its tasks."""
    spark = edges.sparkSession
    return materialize(edges.coalesce(max(spark.sparkContext.defaultParallelism, partitions(spark) // 8)), "components")


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes of edges (a, b); component is the least node.

    Edges are computed once."""
    edges = _written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct())
    while not _stars(edges):
        edges = _written(_small_star(_large_star(edges)))
    roots = edges.select(F.col("a").alias("node")).distinct()
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
