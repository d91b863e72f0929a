"""Checks of stored embedding files and their reconciliation with the source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from corpusflow.functions import vectors as V
from corpusflow.functions.text import megabytes, percent

FILE_KEY = ("dataset", "split", "file")
# Fixed value: source and embedded counts may differ by this much and still match.
COUNT_TOLERANCE = 1


def _listed(*checks: tuple[Column, Column]) -> Column:
    """Messages whose condition holds."""
    return F.array_compact(F.array(*[F.when(condition, message) for condition, message in checks]))


def validate_files(
    rows: DataFrame,
    vector: str = "embeddings",
    index: str = "original_index",
    check_values: bool = True,
) -> DataFrame:
    """One result row per file.

    Everything is a partial aggregate, so a file that holds a third of the rows costs one
    small row per task. The dimension is that of the file's first vector; a column that is
    NULL in the whole file counts as missing. NaN, infinities and a missing index are
    warnings and leave the file valid.
    """
    v, size = F.col(vector), F.size(F.col(vector))
    bytes_ = F.max("file_size") if "file_size" in rows.columns else F.lit(None).cast("long")
    no_count = F.lit(0)
    found = rows.groupBy(*FILE_KEY).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(v).alias("_vectors"),
        F.count(index).alias("_indexed"),
        F.min_by(F.coalesce(size, F.lit(-1)), F.col(index)).alias("_first"),
        F.min(size).alias("min_dim"),
        F.max(size).alias("max_dim"),
        F.sum(V.nan_count(v) if check_values else no_count).alias("nan_n"),
        F.sum(V.inf_count(v) if check_values else no_count).alias("inf_n"),
        bytes_.alias("file_bytes"),
    )
    first = F.coalesce("_first", "min_dim", F.lit(0))
    missing = F.col("_vectors") == 0
    nan_n, inf_n = F.coalesce("nan_n", F.lit(0)), F.coalesce("inf_n", F.lit(0))
    errors = _listed(
        (missing, F.lit("Missing 'embeddings' column")),
        (~missing & (first < 0), F.lit("Invalid embedding type")),
    )
    warnings = _listed(
        (nan_n > 0, F.format_string("Found %d NaN values", nan_n)),
        (inf_n > 0, F.format_string("Found %d Inf values", inf_n)),
        (~missing & (F.col("_indexed") == 0), F.lit("Missing 'original_index' column")),
    )
    return found.select(
        *FILE_KEY,
        "rows",
        F.when(missing, 0).otherwise(F.greatest(first, F.lit(0))).alias("dim"),
        "min_dim",
        "max_dim",
        nan_n.alias("nan_n"),
        inf_n.alias("inf_n"),
        "file_bytes",
        (F.size(errors) == 0).alias("valid"),
        errors.alias("errors"),
        warnings.alias("warnings"),
    )


def whole_files(files: DataFrame, stored: DataFrame) -> DataFrame:
    """Result rows, invalid where a file holds more rows (``stored``) than were read."""
    lost = F.coalesce("stored", F.lit(0)) > F.col("rows")
    error = F.format_string("Only %d of %d rows can be read", "rows", "stored")
    return files.join(stored, list(FILE_KEY), "left").select(
        *[c for c in files.columns if c not in ("valid", "errors", "warnings")],
        (F.col("valid") & ~lost).alias("valid"),
        F.when(lost, F.concat("errors", F.array(error))).otherwise(F.col("errors")).alias("errors"),
        "warnings",
    )


def report(files: DataFrame) -> DataFrame:
    """Samples, files and megabytes per split, per dataset and in total."""
    return (
        files.rollup("dataset", "split")
        .agg(
            F.grouping_id().alias("_level"),
            F.sum("rows").alias("samples"),
            F.count(F.lit(1)).alias("files"),
            megabytes(F.sum(F.coalesce("file_bytes", F.lit(0)))).alias("size_mb"),
            F.count_if(~F.col("valid")).alias("invalid"),
        )
        .withColumn("level", F.element_at(F.array(F.lit("split"), F.lit("dataset"), F.lit(None), F.lit("all")), F.col("_level").cast("int") + 1))
        .drop("_level")
    )


def split_dims(files: DataFrame) -> DataFrame:
    """Dimension of each split: that of its last file with vectors."""
    return files.groupBy("dataset", "split").agg(F.max_by("dim", F.when(F.col("dim") > 0, F.col("file"))).alias("dim"))


def overall(files: DataFrame) -> DataFrame:
    """One row: is everything valid, which dimensions occur, how much is there."""
    distinct_split = F.struct("dataset", "split")
    return files.agg(
        F.coalesce(F.bool_and("valid"), F.lit(True)).alias("all_valid"),
        F.sort_array(F.collect_set(F.when(F.col("dim") > 0, F.col("dim")))).alias("dims"),
        F.countDistinct("dataset").alias("datasets"),
        F.countDistinct(distinct_split).alias("splits"),
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("samples"),
        F.coalesce(F.sum(F.size("errors")), F.lit(0)).alias("errors"),
        F.coalesce(F.sum(F.size("warnings")), F.lit(0)).alias("warnings"),
    )


def issues(files: DataFrame) -> DataFrame:
    """All errors and warnings, one row each, so that no split's list has to fit one cell."""
    marked = F.concat(
        F.transform("errors", lambda m: F.struct(F.lit("error").alias("kind"), m.alias("message"))),
        F.transform("warnings", lambda m: F.struct(F.lit("warning").alias("kind"), m.alias("message"))),
    )
    return files.select(*FILE_KEY, F.inline(marked))


def compare_source(embedded: DataFrame, source: DataFrame) -> DataFrame:
    """Embedded against source counts per split; splits unknown to the source are kept."""
    e, s = F.col("embedded"), F.col("source")
    return embedded.join(source, ["dataset", "split"], "left").select(
        "dataset",
        "split",
        e,
        s,
        (e - s).alias("diff"),
        F.when(s.isNotNull(), percent(e, s)).alias("pct"),
        (F.abs(e - s) <= COUNT_TOLERANCE).alias("matches"),
    )


def first_valid_file(files: DataFrame) -> DataFrame:
    return files.filter(F.col("valid") & (F.col("rows") > 0)).orderBy(*FILE_KEY).limit(1).select(*FILE_KEY)


def sample_vectors(rows: DataFrame, files: DataFrame, n: int = 3, vector: str = "embeddings") -> DataFrame:
    """Statistics of the first vectors of the first valid file, whose names become a filter of the scan."""
    one_file = first_valid_file(files).first()  # a single row
    picked = rows if one_file else rows.limit(0)
    for column in FILE_KEY if one_file else ():
        picked = picked.filter(F.col(column).eqNullSafe(F.lit(one_file[column])))
    return vector_stats(picked.orderBy("original_index").limit(n), [*FILE_KEY, "original_index"], vector)


def vector_stats(rows: DataFrame, keep: Sequence[str], vector: str = "embeddings") -> DataFrame:
    return rows.select(*keep, *[c.alias(n) for n, c in V.stats(F.col(vector)).items()])
