"""Sinks for embeddings, blocks, point tables and quarantined pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusflow.operators.blocks import preview
from corpusflow.operators.fetch import quarantine
from corpusflow.operators.shards import SHARD_KEY, matched
from corpusflow.sources.samples import read_shards

ROWS_PER_FILE = 500_000
#: Rows of smaller files that one task writes.
ROWS_PER_TASK = 250_000


def write_embeddings(rows: DataFrame, root: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """One folder per dataset, split and shard; only the folders written now are replaced.

    Rows are spread by shard and by stretch of the shard, so a shard of any size is written
    by as many tasks as it has files. Small shards cost their files, not their bytes: the number of
    tasks is given, for Spark would merge tasks of few bytes until one writes thousands of files. Rows
    the encoder refused have no vector and are not written.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stretch = F.expr(f"original_index div {int(rows_per_file)}")
    (
        rows.filter(F.col("embeddings").isNotNull())
        .select(*SHARD_KEY, "embeddings", "original_index")
        .repartition(tasks, *SHARD_KEY, stretch)
        .sortWithinPartitions(*SHARD_KEY, "original_index")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(*SHARD_KEY)
        .parquet(root)
    )


#: Below the root of the shards; readers of the tree pass over names that begin like this.
MANIFEST = "_manifest"


def write_shards(rows: DataFrame, root: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write ``rows``, which have ``total_shards``, and then list their shards in the manifest.

    ``rows`` is a stored table: it is read twice. The manifest's entries, one row for each shard
    with its plan, rows and files, are committed as a single file, after all files of the shards
    are in place. A shard without an entry, or with other rows than its entry says, is not done.
    """
    write_embeddings(rows, root, rows_per_file)
    spark = rows.sparkSession
    kept = rows.filter(F.col("embeddings").isNotNull())
    meant = kept.groupBy(*SHARD_KEY, "total_shards").agg(F.count(F.lit(1)).alias("rows"))
    there = shard_files(spark, root).withColumnRenamed("rows", "found")
    entries = matched(meant, there, SHARD_KEY).filter("rows = found").drop("found")
    entries.withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{root}/{MANIFEST}")


def shard_files(spark: SparkSession, root: str) -> DataFrame:
    """Rows and files of each shard's folder, by the files' footers."""
    path = F.col("_metadata.file_path")
    return read_shards(spark, root).groupBy(*SHARD_KEY).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(path).alias("files")
    )


def committed_shards(spark: SparkSession, root: str, plan: DataFrame) -> DataFrame:
    """``dataset, split, shard_id, samples`` of the shards of ``plan`` that are stored whole.

    ``plan`` has ``dataset, split, total_shards``. The last entry of a shard counts, if it is of
    this plan and the shard's files still have its rows.
    """
    schema = "dataset string, split string, shard_id int, total_shards int, rows long, files long, at timestamp"
    entries = spark.read.schema(schema).parquet(f"{root}/{MANIFEST}")
    last = entries.groupBy(*SHARD_KEY).agg(F.max_by(F.struct("total_shards", "rows", "files"), "at").alias("e"))
    last = last.select(*SHARD_KEY, "e.*")
    planned = plan.select("dataset", "split", "total_shards").distinct()
    whole = matched(shard_files(spark, root), last, [*SHARD_KEY, "rows", "files"])
    return matched(whole, planned, ["dataset", "split", "total_shards"], "left_semi").select(*SHARD_KEY, F.col("rows").alias("samples"))


def write_blocks(records: DataFrame, root: str, folder_per_page: bool = False, pages_per_task: int = 64) -> None:
    """Block records as JSON, one folder per document or, on request, per document and page.

    A stretch of pages goes to one task, which keeps the blocks of a page together and spreads
    a document with very many pages.
    """
    stretch = F.expr(f"page div {int(pages_per_task)}")
    folders = ["document", "page"] if folder_per_page else ["document"]
    (
        records.repartition("document", stretch)
        .sortWithinPartitions("document", "page", "block_id")
        .write.mode("overwrite")
        .option("ignoreNullFields", "false")
        .partitionBy(*folders)
        .json(root)
    )


def write_block_store(records: DataFrame, root: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Block records as Parquet files that each hold a range of documents, pages and blocks.

    Files are bounded in rows, however many documents there are and however long one is. A task
    writes one file after the other: for each range of its own Spark would sample keys on the driver. The
    files' statistics tell which of them hold a document, see :func:`corpusflow.sources.samples.read_block_store`.
    """
    order = ["document", "page", "block_id"]
    tasks = max(1, -(-records.count() // max(rows_per_file, ROWS_PER_TASK)))
    (
        records.repartitionByRange(tasks, *order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", rows_per_file)
        .parquet(root)
    )


def write_embedding_json(rows: DataFrame, root: str, metadata: Column, rows_per_object: int = 1_000) -> None:
    """Rows ``(dataset, split, text, embedding, original_index)`` as ``{embeddings, metadata}`` objects.

    Each object holds a stretch of one split, or of one of its shards where rows have a
    ``shard_id``, so none grows with the data.
    """
    item = F.struct("embedding", "split", "text", "dataset")
    stretch = F.expr(f"original_index div {int(rows_per_object)}")
    ordered = F.array_sort(F.collect_list(F.struct("original_index", item.alias("item"))))
    shard = [c for c in ("shard_id",) if c in rows.columns]  # positions start again in each
    objects = rows.groupBy("dataset", "split", *shard, stretch.alias("_stretch")).agg(ordered.alias("_items"))
    objects.select(
        F.transform("_items", lambda i: i["item"]).alias("embeddings"), metadata.alias("metadata")
    ).write.mode("overwrite").option("ignoreNullFields", "false").json(root)


def write_preview(blocks: DataFrame, root: str) -> None:
    """Block preview as tab-separated text with a header."""
    preview(blocks).write.mode("overwrite").option("sep", "\t").option("header", "true").option(
        "escape", '"'
    ).csv(root)


def write_structured(archives_json: DataFrame, root: str) -> None:
    """Extracted JSON of the archives that had it, one ``{"document", "data"}`` object per line."""
    found = archives_json.filter(F.col("json").isNotNull())
    compact = F.regexp_replace("json", r"[\r\n]+", " ")
    document = F.to_json(F.struct("document"))
    line = F.concat(F.regexp_replace(document, r"\}$", ',"data":'), compact, F.lit("}"))
    found.select(line.alias("value")).write.mode("overwrite").text(root)


def write_points(points: DataFrame, root: str, fmt: str = "parquet") -> None:
    table = points.select("x", "y", "split", "dataset", "text")
    writer = table.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", "true").option("escape", '"')
    writer.format(fmt).save(root)


def write_quarantine(pages: DataFrame, root: str) -> None:
    """Pages whose link was not found, with their HTML, for inspection."""
    quarantine(pages).write.mode("overwrite").parquet(root)
