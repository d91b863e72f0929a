"""Vectors joined back to the samples they were made from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

POSITION = ("dataset", "split", "shard_id", "original_index")
# Fixed value: characters of text kept beside a vector.
TEXT_CHARS = 100


def attach_source(vectors: DataFrame, samples: DataFrame, text: str = "text", on: Sequence[str] = POSITION) -> DataFrame:
    """Each vector with the start of its text.

    The position is unique, so the join key spreads evenly however large a split is; only
    the cut text is shuffled.
    """
    texts = samples.select(*on, F.substring(text, 1, TEXT_CHARS).alias("text"))
    return vectors.join(texts, list(on), "inner")


def set_metadata(vectors: DataFrame, vector: str = "embeddings", index: str = "original_index") -> DataFrame:
    """Size, dimension, splits and datasets of an embedding set."""
    return vectors.agg(
        F.count(F.lit(1)).alias("total"),
        F.min_by(F.size(vector), F.col(index)).alias("dim"),
        F.sort_array(F.collect_set("split")).alias("splits"),
        F.sort_array(F.collect_set("dataset")).alias("datasets"),
    )


def legend(rows: DataFrame, label: str = "split") -> DataFrame:
    """Slot of each label in sorted order, with its row count.

    The window runs over the distinct labels, which are split names, not rows.
    """
    counts = rows.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("slot", F.row_number().over(Window.orderBy(label)) - 1)


def with_slots(rows: DataFrame, label: str = "split") -> DataFrame:
    """Rows with the legend slot of their label; the optimiser broadcasts a small legend."""
    return rows.join(legend(rows, label).drop("n"), label, "left")
