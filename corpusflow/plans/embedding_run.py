"""Whole runs: samples to embeddings, stored embeddings to a report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusflow.functions.text import has_text
from corpusflow.operators import encode, ordering, shards, validation
from corpusflow.operators.catalog import spec_of
from corpusflow.operators.text_samples import with_text
from corpusflow.session import stored
from corpusflow.sources import samples as sources

#: Rows numbered together on the way to the encoder: the task that numbers them encodes them too.
ROWS_PER_BUCKET = 20_000


@dataclass(frozen=True)
class ShardRun:
    """``embeddings`` and the ``status`` of each shard."""

    embeddings: DataFrame
    status: DataFrame


def sharded_texts(
    samples: DataFrame, key: str, total_shards: Column, rows_per_bucket: int = ordering.ROWS_PER_BUCKET
) -> DataFrame:
    """``dataset, split, key, shard_id, original_index, text, has_text`` of every sample.

    The position counts all samples of a shard, those without text included. A job that only
    needs ``has_text`` does not shuffle the texts.
    """
    texts = with_text(samples, exclude=("dataset", "split", key), out="_text")
    slim = texts.select("dataset", "split", key, F.col("_text").alias("text"), has_text(F.col("_text")).alias("has_text"))
    return shards.assign(slim, key, total_shards, rows_per_bucket)


def shard_status(sharded: DataFrame, done: DataFrame, failed: DataFrame | None = None) -> DataFrame:
    """``success``, ``skipped``, ``no_text`` or ``error`` per shard, with its samples.

    ``done(dataset, split, shard_id, samples)`` lists shards already stored; ``failed`` counts
    rows the encoder refused as ``errors``.
    """
    key = list(shards.SHARD_KEY)
    found = sharded.groupBy(*key).agg(F.count_if("has_text").alias("_texts"))
    found = shards.matched(found, done.select(*key, F.col("samples").alias("_stored")), key, "left")
    if failed is not None:
        found = shards.matched(found, failed.select(*key, "errors"), key, "left")
    else:
        found = found.withColumn("errors", F.lit(0))
    errors = F.coalesce("errors", F.lit(0))
    return found.select(
        *key,
        spec_of(F.col("dataset"), F.col("split"), F.col("shard_id")).alias("shard"),
        F.when(F.col("_stored").isNotNull(), "skipped")
        .when(F.col("_texts") == 0, "no_text")
        .when(errors > 0, "error")
        .otherwise("success")
        .alias("status"),
        F.coalesce("_stored", F.col("_texts") - errors).cast("long").alias("samples"),
    )


def refused(encoded: DataFrame) -> DataFrame:
    """Rows per shard the encoder refused, as ``errors``; pass a stored table, not a plan that encodes again."""
    bad = encoded.filter(F.col("error").isNotNull() | F.col("embeddings").isNull())
    return bad.groupBy(*shards.SHARD_KEY).agg(F.count(F.lit(1)).alias("errors"))


def embed_shards(
    samples: DataFrame,
    key: str,
    total_shards: Column,
    done: DataFrame,
    factory: encode.EncoderFactory | None = None,
    prefix: str = "",
) -> ShardRun:
    """Embed every shard that is not done yet.

    One pass: text, position, resume filter, encoder. The shuffle that numbers the rows is
    the only one on the way to the encoder, so its buckets are small and a large split is encoded
    by many tasks. The vectors are stored before the status is made,
    which counts the rows the encoder refused without encoding twice.
    """
    sharded = sharded_texts(samples, key, total_shards, ROWS_PER_BUCKET)
    todo = shards.pending(sharded, done).filter("has_text")
    keep = [*shards.SHARD_KEY, "total_shards", "original_index", key]
    encoded = stored(encode.embed(todo, "text", factory, prefix, keep=keep), "encoded")
    return ShardRun(encoded, shard_status(sharded, done, refused(encoded)))


def _results(spark: SparkSession, where: str | Sequence[str], listed: DataFrame, check_values: bool) -> DataFrame:
    """Result rows of the listed files. They are stored: a later choice of columns would skip damaged pages."""
    files = stored(validation.validate_files(sources.read_embedding_tree(spark, where), check_values=check_values), "files")
    every = files.unionByName(sources.unread_files(listed, files))
    return validation.whole_files(every, sources.stored_rows(spark, where))


def validate_tree(spark: SparkSession, root: str, check_values: bool = True) -> DataFrame:
    """Result row of every file of ``root/dataset/split/*.parquet``, empty and broken ones included.

    A file that gave fewer rows than its footer states is invalid.
    """
    return _results(spark, root, sources.list_files(spark, root, "*.parquet"), check_values)


def validate_changed(spark: SparkSession, root: str, known: DataFrame | None = None, check_values: bool = True) -> DataFrame:
    """``validate_tree`` with ``path, length, modified`` of each file, reading only what changed.

    ``known`` is an earlier result, stored by the caller. A file it has with the same length and
    time of change keeps its result and is not opened; files that are gone are left out.
    """
    now = sources.listing(spark, root, "*.parquet")
    state = ["path", "length", "modified"]
    changed = now if known is None else now.join(known.select(*state), state, "left_anti")
    paths = [row["path"] for row in changed.select("path").collect()]  # Spark takes the files to read as a list
    if known is not None and not paths:
        return known.join(now, state, "left_semi")
    results = _results(spark, paths or root, changed, check_values)
    named = changed.select(*sources.file_names(F.col("path")), *state)
    checked = results.join(named, list(validation.FILE_KEY))
    return checked if known is None else checked.unionByName(known.join(now, state, "left_semi"))


def validation_report(embeddings: DataFrame) -> DataFrame:
    """Files checked and rolled up by dataset and split."""
    return validation.report(validation.validate_files(embeddings))
