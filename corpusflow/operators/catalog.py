"""Datasets, splits and shards as tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusflow import schemas
from corpusflow.functions.text import cut

# Fixed value: splits whose name holds this word are left out unless asked for by name.
EXCLUDED_WORD = "multilingual"


def registry(spark: SparkSession, rows: Iterable[tuple]) -> DataFrame:
    """Known datasets: short name, source name, sub-configuration, folder and group."""
    return spark.createDataFrame(list(rows), schemas.REGISTRY)


def requested(known: DataFrame, names: Sequence[str]) -> DataFrame:
    """Registry rows asked for by dataset or group name; an empty request means all."""
    if not names:
        return known
    return known.filter(F.col("dataset").isin(*names) | F.col("grp").isin(*names))


def union_samples(parts: Sequence[DataFrame]) -> DataFrame:
    """Samples of several datasets under one schema; columns a dataset lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def excluded(split: Column) -> Column:
    return F.lower(split).contains(EXCLUDED_WORD)


def list_splits(samples: DataFrame) -> DataFrame:
    """Splits present, each with the flag that all-splits mode leaves it out."""
    return samples.select("dataset", "split").distinct().withColumn("excluded", excluded(F.col("split")))


def absent(known: DataFrame, splits: DataFrame) -> DataFrame:
    """Registry datasets without a single split."""
    return known.join(splits.select("dataset").distinct(), "dataset", "left_anti")


def parse_specs(specs: DataFrame) -> DataFrame:
    """``dataset:split`` taken apart at the first colon; NULL parts mark a bad spec."""
    well_formed = F.col("spec").contains(":")
    return specs.select(
        "spec",
        F.when(well_formed, F.substring_index("spec", ":", 1)).alias("dataset"),
        F.when(well_formed, F.regexp_extract("spec", r"(?s)^[^:]*:(.*)$", 1)).alias("split"),
    )


def resolve_specs(specs: DataFrame, known: DataFrame, splits: DataFrame) -> DataFrame:
    """Each spec with ``ok`` or the reason it cannot be used.

    The registry and the split list hold one row per dataset and split, so the three joins
    are planned by size: small sides are broadcast by the optimiser, large ones shuffled.
    """
    datasets = known.select("dataset", F.lit(True).alias("_known"))
    present = splits.select("dataset").distinct().withColumn("_present", F.lit(True))
    exact = splits.select("dataset", "split").withColumn("_split", F.lit(True))
    return (
        parse_specs(specs)
        .join(datasets, "dataset", "left")
        .join(present, "dataset", "left")
        .join(exact, ["dataset", "split"], "left")
        .select(
            "spec",
            "dataset",
            "split",
            F.when(F.col("dataset").isNull(), "bad_format")
            .when(F.col("_known").isNull(), "unknown_dataset")
            .when(F.col("_present").isNull(), "not_downloaded")
            .when(F.col("_split").isNull(), "split_not_found")
            .otherwise("ok")
            .alias("status"),
        )
    )


def chosen_splits(splits: DataFrame, specs: DataFrame | None, known: DataFrame, take_all: bool) -> DataFrame:
    """Splits to process. All-splits mode wins over specs and drops the excluded ones."""
    if take_all or specs is None:
        picked = splits.filter(~excluded(F.col("split")))
    else:
        picked = resolve_specs(specs, known, splits).filter(F.col("status") == "ok")
    return picked.select("dataset", "split").distinct()


def split_counts(samples: DataFrame) -> DataFrame:
    return samples.groupBy("dataset", "split").agg(F.count(F.lit(1)).alias("n"))


def dataset_summary(wanted: DataFrame, counts: DataFrame) -> DataFrame:
    """Per requested dataset its sorted split names, sample count and whether it is there."""
    per_dataset = counts.groupBy("dataset").agg(
        F.array_join(F.sort_array(F.collect_set("split")), ", ").alias("splits"), F.sum("n").alias("n")
    )
    return wanted.join(per_dataset, "dataset", "left").select(
        "dataset",
        F.coalesce("splits", F.lit("")).alias("splits"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
        F.col("n").isNotNull().alias("ok"),
    )


def spec_of(dataset: Column, split: Column, shard: Column) -> Column:
    return F.concat(dataset, F.lit(":"), split, F.lit(":shard"), shard)


def file_name(dataset: Column, split: Column, shard: Column, total: Column) -> Column:
    return F.format_string("%s-%s-%05d-of-%05d.parquet", dataset, split, shard, total)


def shard_plan(splits: DataFrame) -> DataFrame:
    """One row per shard of each ``(dataset, split, total_shards)``, in working order."""
    shard = F.explode(F.sequence(F.lit(0), F.col("total_shards") - 1)).alias("shard_id")
    names = F.col("dataset"), F.col("split"), F.col("shard_id")
    return (
        splits.select("dataset", "split", F.col("total_shards").cast("int"), shard)
        .withColumn("spec", spec_of(*names))
        .withColumn("file", file_name(*names, F.col("total_shards")))
        .orderBy("dataset", "split", "shard_id")
    )


def shards_from_files(splits: DataFrame, files: DataFrame) -> DataFrame:
    """Shards per split counted from stored files, at least one.

    ``files(dataset, path)`` belongs to a split when a folder on the path carries the split's
    name, or the file name holds it between two dashes. Both tests become equal names: every
    folder and every inner run of dash-separated words is a candidate.
    """
    folders = F.slice(F.split("path", "/"), 2, F.greatest(F.size(F.split("path", "/")) - 2, F.lit(0)))
    words = F.split(F.element_at(F.split("path", "/"), -1), "-")
    inner = F.flatten(
        F.transform(
            F.when(F.size(words) > 2, F.sequence(F.lit(2), F.size(words) - 1)).otherwise(F.array().cast("array<int>")),
            lambda start: F.transform(
                F.sequence(F.lit(1), F.size(words) - start),
                lambda length: F.array_join(F.slice(words, start, length), "-"),
            ),
        )
    )
    owners = files.select("dataset", "path", F.explode(F.array_union(folders, inner)).alias("split"))
    found = (
        owners.join(splits.select("dataset", "split"), ["dataset", "split"], "left_semi")
        .distinct()
        .groupBy("dataset", "split")
        .agg(F.count(F.lit(1)).alias("_files"))
    )
    return splits.join(found, ["dataset", "split"], "left").select(
        *splits.columns, F.greatest(F.lit(1), F.coalesce("_files", F.lit(1))).cast("int").alias("total_shards")
    )


def preview(samples: DataFrame, order: Sequence[str], limit: int = 500) -> DataFrame:
    """Fields of the first sample as rows, long strings cut.

    The least key is found on the order columns alone; only its row is read whole.
    """
    least = samples.agg(F.min(F.struct(*order)).alias("least")).first()["least"]  # one row
    first = samples.limit(0)
    if least is not None:
        found = samples
        for column, value in zip(order, least):
            found = found.filter(F.col(column).eqNullSafe(F.lit(value)))
        first = found.limit(1)
    return first.select(*_shown(samples.columns, limit)).unpivot([], list(samples.columns), "field", "value")


def _shown(columns: Sequence[str], limit: int) -> list[Column]:
    return [cut(F.col(c).cast("string"), limit).alias(c) for c in columns]


def split_previews(samples: DataFrame, order: Sequence[str], by: Sequence[str] = ("dataset", "split"), limit: int = 500) -> DataFrame:
    """Fields of the first sample of every split as rows, long strings cut before they are shuffled."""
    fields = [c for c in samples.columns if c not in by]
    first = F.min_by(F.struct(*_shown(fields, limit)), F.struct(*order))
    return samples.groupBy(*by).agg(first.alias("_first")).select(*by, "_first.*").unpivot(list(by), fields, "field", "value")
