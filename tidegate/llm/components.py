"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import stored


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) → (node, component): the smallest node that can be reached, for every node with an edge.

    Every round, a node takes the smallest label around it and then the label of that label, so that
    distances to the smallest node shrink by more than half. No part of the graph meets in one task or the driver.
    An edge with a null end is ignored; an edge from a node to itself makes a component of one.
    """
    edges = edges.filter("a IS NOT NULL AND b IS NOT NULL")
    both = stored(spark, edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                  .distinct(), "edges")
    labels = stored(spark, both.groupBy("a").agg(F.min("b").alias("least"))
                    .select(F.col("a").alias("node"), F.least("a", "least").alias("label")), "labels")
    while True:
        around = (both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("around")))
        hooked = labels.join(around, labels.node == around.a).select(
            "node", F.col("label").alias("old"), F.least("label", "around").alias("label"))
        of_label = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        jumped = stored(spark, hooked.join(of_label, "label", "left").select(
            "node", "old", F.least("label", F.coalesce("next", "label")).alias("label")), "labels")
        labels = jumped.select("node", "label")
        if jumped.filter("label < old").isEmpty():
            return labels.withColumnRenamed("label", "component")
