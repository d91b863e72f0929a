"""Contiguous shards of splits, and which of them are still to be done."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from corpusflow.operators import ordering

SHARD_KEY = ("dataset", "split", "shard_id")


def shard_count(n: Column, rows_per_shard: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(n / rows_per_shard)).cast("long")


def assign(
    samples: DataFrame,
    key: str,
    total_shards: Column,
    rows_per_bucket: int = ordering.ROWS_PER_BUCKET,
) -> DataFrame:
    """``shard_id`` and ``original_index`` of every sample of every split.

    Samples are numbered by ``key`` within their split and cut into contiguous shards; the
    first ``n mod k`` shards get one extra row. ``total_shards`` may use the row's columns
    and ``_n``, the size of its split.
    """
    numbered = ordering.positions(samples, ["dataset", "split"], [key], "_idx", "_n", rows_per_bucket)
    k, idx = F.col("_k"), F.col("_idx")
    base, extra = F.expr("_n div _k"), F.expr("_n % _k")
    long_part = extra * (base + 1)
    in_long = F.expr("_idx div (_n div _k + 1)")
    in_short = extra + F.floor((idx - long_part) / F.greatest(base, F.lit(1)))
    sharded = numbered.withColumn("_k", total_shards.cast("long")).withColumn(
        "shard_id", F.when(idx < long_part, in_long).otherwise(in_short).cast("int")
    )
    start = F.col("shard_id") * base + F.least(F.col("shard_id"), extra)
    return sharded.withColumn("original_index", (idx - start).cast("long")).withColumn(
        "total_shards", k.cast("int")
    ).drop("_idx", "_n", "_k")


def matched(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """A join on keys of which some may be missing: no split is a split of its own."""
    named = right.select(*[F.col(c).alias(f"_on_{c}") if c in keys else F.col(c) for c in right.columns])
    return left.join(named, [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in keys], how).drop(*[f"_on_{c}" for c in keys])


def pending(work: DataFrame, done: DataFrame, keys: Sequence[str] = SHARD_KEY) -> DataFrame:
    """Rows of ``work`` whose key is not in ``done``."""
    return matched(work, done.select(*keys), keys, "left_anti")


def skipped(work: DataFrame, done: DataFrame, keys: Sequence[str] = SHARD_KEY) -> DataFrame:
    """Rows of ``work`` whose key is already in ``done``."""
    return matched(work, done.select(*keys), keys, "left_semi")


def done_from_files(files: DataFrame, plan: DataFrame) -> DataFrame:
    """Shards of ``plan`` whose ``…-00003-of-00010.parquet`` file was found valid, with their samples.

    ``plan`` has ``dataset, split, total_shards``: a file of another number of shards is no part
    of it. Files that cannot be read are not listed, so their shards are done again.
    """
    part = [F.regexp_extract("file", r"-(\d+)-of-(\d+)\.parquet$", i) for i in (1, 2)]
    named = files.filter(F.col("valid") & (part[0] != ""))
    found = named.groupBy(
        "dataset", "split", part[0].cast("int").alias("shard_id"), part[1].cast("int").alias("total_shards")
    ).agg(F.sum("rows").alias("samples"))
    planned = plan.select("dataset", "split", "total_shards").distinct()
    return matched(found, planned, ["dataset", "split", "total_shards"], "left_semi").drop("total_shards")
