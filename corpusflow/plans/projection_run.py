"""Whole run from embedding JSON to plot points."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusflow.operators import projection
from corpusflow.session import stored
from corpusflow.sources.samples import read_embedding_json


def points_of_json(
    spark: SparkSession,
    path: str,
    multi_line: bool = True,
    n_neighbors: int = 15,
    min_dist: float = 0.1,
    epochs: int = 200,
) -> DataFrame:
    """``x, y, split, dataset, text`` of every item that has a vector."""
    items = read_embedding_json(spark, path, multi_line).drop("metadata")
    # Items carry no id of their own; the table written here fixes the one they get.
    numbered = stored(items.withColumn("item", F.monotonically_increasing_id()), "items")
    positions = projection.layout_2d(numbered, "item", "embedding", n_neighbors, min_dist, epochs)
    return projection.point_table(positions, numbered, ["item"]).drop("item")
