"""Connected components of an edge table by contraction, each round a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millsight.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); a component is named by one of its nodes.

    Each round maps every node to the least node next to it and keeps the edges between different
    images, so connectivity never changes and nodes only disappear. Node names should be hashes: on
    random names a path shrinks by a constant factor a round. Nothing is gathered on the driver.
    """
    edges = edges.select("a", "b").filter("a <> b").distinct()
    edges = written(edges, "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least"))
        image = written(
            least.select(F.col("a").alias("old"), F.least("a", "least").alias("new")), "images"
        )
        if labels is None:
            labels = image.select(F.col("old").alias("node"), F.col("new").alias("component"))
        else:
            moved = labels.join(image, labels["component"] == image["old"], "left")
            component = F.coalesce("new", "component").alias("component")
            labels = written(moved.select("node", component), "labels")
        edges = (
            edges.join(image, edges["a"] == image["old"])
            .select(F.col("new").alias("a"), "b")
            .join(image.select(F.col("old").alias("_old"), F.col("new").alias("_new")), F.col("b") == F.col("_old"))
            .select("a", F.col("_new").alias("b"))
            .filter("a <> b")
            .distinct()
        )
        edges = written(edges, "edges")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
