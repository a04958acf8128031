"""Sets of image ids, and edges looked up by their ends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def endpoints(edges: DataFrame) -> DataFrame:
    """(image_id) of every image with an edge."""
    return edges.select(F.col("src").alias("image_id")).unionByName(edges.select(F.col("dst").alias("image_id"))).distinct()


def present(nodes: DataFrame, ids: DataFrame) -> DataFrame:
    """Nodes whose id is among ``ids``."""
    return nodes.join(ids, "image_id", "left_semi")


def missing(nodes: DataFrame, ids: DataFrame) -> DataFrame:
    """Nodes whose id is not among ``ids``."""
    return nodes.join(ids, "image_id", "left_anti")


def union(a: DataFrame, b: DataFrame) -> DataFrame:
    """(image_id) in either."""
    return a.select("image_id").unionByName(b.select("image_id")).distinct()


def with_both_ends(edges: DataFrame, angles: DataFrame) -> DataFrame:
    """Edges both of whose ends are in ``angles(node, angle, component)`` with the same component."""
    end = lambda to, name: angles.select(F.col("node").alias(to), F.col("angle").alias(f"angle_{name}"), F.col("component").alias(f"component_{name}"))
    joined = edges.join(end("src", "a"), "src").join(end("dst", "b"), "dst").where("component_a = component_b")
    return joined.withColumnRenamed("component_a", "component").drop("component_b")
