"""Sample rows to texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from corpusflow.functions.once import computed
from corpusflow.functions.text import BLANK_LINE, has_text, sample_text


def with_text(samples: DataFrame, exclude: Sequence[str] = ("dataset", "split"), out: str = "text") -> DataFrame:
    """Samples with their text. Joined message lists are computed once, also when filtered on."""
    text = sample_text(samples, exclude)
    if any(f.name in ("messages", "conversation") and f.name not in exclude for f in samples.schema):
        return samples.select(*[c for c in samples.columns if c != out], computed(**{out: text}))
    return samples.withColumn(out, text)


def only_with_text(samples: DataFrame, text: str = "text") -> DataFrame:
    return samples.filter(has_text(F.col(text)))


def turn_parts(turns: DataFrame, key: str = "conv_id", turns_per_part: int = 256) -> DataFrame:
    """Stretches of a conversation as ``(key, part, text)``.

    ``turns(key, turn, text)`` of a conversation of any length are spread over tasks by
    stretch of turns; a stretch is bounded, a conversation is not. NULL texts are skipped.
    """
    part = F.expr(f"turn div {int(turns_per_part)}").cast("long").alias("part")
    ordered = F.array_sort(F.collect_list(F.when(F.col("text").isNotNull(), F.struct("turn", "text"))))
    return turns.groupBy(key, part).agg(
        F.array_join(F.transform(ordered, lambda t: t["text"]), BLANK_LINE).alias("text"),
        F.count("text").alias("_texts"),
    )


def text_of_turns(turns: DataFrame, key: str = "conv_id", turns_per_part: int = 256) -> DataFrame:
    """One text per conversation: turns in order, joined by a blank line.

    The result is one cell per conversation and so limited to Spark's 2 GB; use
    :func:`turn_parts` for longer ones.
    """
    parts = turn_parts(turns, key, turns_per_part)
    ordered = F.array_sort(F.collect_list(F.when(F.col("_texts") > 0, F.struct("part", "text"))))
    return parts.groupBy(key).agg(F.array_join(F.transform(ordered, lambda p: p["text"]), BLANK_LINE).alias("text"))
