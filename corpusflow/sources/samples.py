"""Staged samples, embedding files and layout pages as tables."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import islice
from math import ceil

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T

from corpusflow import schemas
from corpusflow.operators.provenance import TEXT_CHARS
from corpusflow.session import LISTING_WAVES, OPEN_BYTES, small_files, stored


def read_samples(
    spark: SparkSession, root: str, schema: T.StructType, fmt: str = "parquet", split: str | None = None
) -> DataFrame:
    """Samples below ``dataset=…/split=…`` folders; a split named here is pruned to its folder."""
    full = T.StructType([*schema.fields, T.StructField("dataset", T.StringType()), T.StructField("split", T.StringType())])
    samples = spark.read.format(fmt).schema(full).load(root)
    return samples.filter(F.col("split") == split) if split else samples


def list_files(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """Path and size of the files below ``root``; contents are not read."""
    return (
        small_files(spark)
        .read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", "length")
    )


def listing(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """Path, length and time of the last change of the files below ``root``; contents are not read."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(root)
    )
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def _path_part(path: Column, from_end: int) -> Column:
    """Part of a path counted from the end, with any ``name=`` of a partition folder taken off."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -from_end), "^[^=]*=", "")


def file_names(path: Column) -> list[Column]:
    """Dataset, split and file of ``…/dataset/split/file``."""
    file = F.element_at(F.split(path, "/"), -1).alias("file")
    return [_path_part(path, 3).alias("dataset"), _path_part(path, 2).alias("split"), file]


def _embedding_tree(spark: SparkSession, root: str | Sequence[str]) -> DataFrame:
    """All files below ``root``, or the files listed."""
    return (
        spark.read.schema(schemas.EMBEDDING)
        .option("ignoreCorruptFiles", "true")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .parquet(*([root] if isinstance(root, str) else root))
    )


def stored_rows(spark: SparkSession, root: str | Sequence[str]) -> DataFrame:
    """Rows that each readable footer of a tree states, as ``stored``: a scan of no column reads no page."""
    files = _embedding_tree(spark, root).groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("stored"))
    return files.select(*file_names(F.col("path")), "stored")


def read_embedding_tree(spark: SparkSession, root: str | Sequence[str]) -> DataFrame:
    """Embedding rows of ``root/dataset/split/*.parquet``, tagged with their file and its size.

    A damaged file gives the rows before the damage only: hold them against :func:`stored_rows`.
    """
    path = F.col("_metadata.file_path")
    return _embedding_tree(spark, root).select(
        *file_names(path),
        F.col("_metadata.file_size").alias("file_size"),
        "embeddings",
        "original_index",
    )


def read_shards(spark: SparkSession, root: str) -> DataFrame:
    """Rows written by :func:`corpusflow.sources.writers.write_embeddings`."""
    keys = [
        T.StructField("dataset", T.StringType()),
        T.StructField("split", T.StringType()),
        T.StructField("shard_id", T.IntegerType()),
    ]
    return small_files(spark).read.schema(T.StructType([*schemas.EMBEDDING.fields, *keys])).parquet(root)


def opened(path: str):
    """A file of any store as a seekable stream, of which only what is asked for is read."""
    import pyarrow.fs as pafs

    files, name = pafs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
    return files.open_input_file(name)


def _footer_problem(path: str) -> str | None:
    import pyarrow.parquet as pq

    try:
        with opened(path) as file:
            columns = pq.ParquetFile(file).schema_arrow.names
    except Exception as failure:
        return f"Error reading file: {failure}"
    return None if "embeddings" in columns else "Missing 'embeddings' column"


def unread_files(files: DataFrame, seen: DataFrame) -> DataFrame:
    """Result rows for the listed ``files(path, length)`` that gave no rows: empty ones are valid, others are not.

    Only the footers of those files are read, in parallel.
    """

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.drop(columns="path").assign(problem=batch["path"].map(_footer_problem))

    key = ["dataset", "split", "file"]
    named = files.select(*file_names(F.col("path")), F.col("length").alias("file_bytes"), "path")
    unread = named.join(seen.select(*key).distinct(), key, "left_anti")
    schema = "dataset string, split string, file string, file_bytes long, problem string"
    problem = F.col("problem")
    none = F.array().cast("array<string>")
    return unread.mapInPandas(check, schema).select(
        *key,
        F.lit(0).cast("long").alias("rows"),
        F.lit(0).alias("dim"),
        F.lit(None).cast("int").alias("min_dim"),
        F.lit(None).cast("int").alias("max_dim"),
        F.lit(0).cast("long").alias("nan_n"),
        F.lit(0).cast("long").alias("inf_n"),
        "file_bytes",
        problem.isNull().alias("valid"),
        F.when(problem.isNull(), none).otherwise(F.array(problem)).alias("errors"),
        none.alias("warnings"),
    )


def read_embedding_json(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Items of embedding JSON files that have a vector, text cut, with the file's metadata.

    A file is one object over many lines, or one object per line with ``multi_line`` off.
    """
    files = spark.read.schema(schemas.EMBEDDING_JSON).option("multiLine", multi_line).json(path)
    return (
        files.select(F.explode("embeddings").alias("e"), "metadata")
        .filter(F.col("e.embedding").isNotNull())
        .select(
            "e.embedding",
            "e.split",
            F.substring("e.text", 1, TEXT_CHARS).alias("text"),
            "e.dataset",
            "metadata",
        )
    )


#: Files of up to so many bytes are read whole, many by a task; Spark's reader streams the larger ones.
WHOLE_BYTES = 64 * 1024 * 1024
#: Bytes of contents, and number of names, that a task passes on at once.
_BATCH_BYTES, _BATCH_NAMES = 4 * 1024 * 1024, 10_000
#: Bytes of a task's files, where each file counts as ``OPEN_BYTES`` more.
_TASK_BYTES = 128 * 1024 * 1024


def _store(root: str):
    """The file system of a folder, and the folder's path in it."""
    import pyarrow.fs as pafs

    return pafs.FileSystem.from_uri(re.sub("^file:/+", "file:///", root))


def _known_store(root: str) -> bool:
    import pyarrow as pa

    try:
        _store(root)
    except (pa.ArrowException, OSError):
        return False
    return True


def _entries(store, folder: str) -> Iterator[tuple[str, bool, int]]:
    """Name of what lies in a folder, whether it is a folder, and its size; names of a mounted folder are not held all at once."""
    import pyarrow.fs as pafs

    if isinstance(store, pafs.LocalFileSystem):
        with os.scandir(folder) as found:
            for entry in found:
                yield (entry.name, True, 0) if entry.is_dir() else (entry.name, False, entry.stat().st_size)
    else:
        for entry in store.get_file_info(pafs.FileSelector(folder)):
            yield entry.base_name, entry.type == pafs.FileType.Directory, entry.size or 0


def _hidden(name: str) -> bool:
    """Names that Spark's readers leave out."""
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def _files_below(spark: SparkSession, root: str, ending: str) -> DataFrame:
    """``at, length`` of files below ``root``: folders are listed by tasks, a level at a time, and nothing is kept on the driver."""

    def entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = _store(root)
        for batch in batches:
            for folder in batch["at"]:
                found = _entries(store, base + folder)
                shown = ((f"{folder}/{n}", is_folder, size) for n, is_folder, size in found if not _hidden(n) and (is_folder or n.endswith(ending)))
                while some := list(islice(shown, _BATCH_NAMES)):
                    yield pd.DataFrame(some, columns=["at", "folder", "length"])

    folders, levels = spark.createDataFrame([("",)], "at string"), []
    while folders is not None:
        found = stored(folders.mapInPandas(entries, "at string, folder boolean, length long"), "listed")
        levels.append(found.filter(~F.col("folder")).select("at", "length"))
        below = found.filter("folder").select("at")
        folders = below.repartition(LISTING_WAVES * spark.sparkContext.defaultParallelism, "at") if below.head(1) else None
    return reduce(DataFrame.unionByName, levels)


def _contents(spark: SparkSession, root: str, files: DataFrame, total: Row) -> DataFrame:
    """``at, content`` of small files, dealt over tasks by their number and bytes."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = _store(root)
        rows, n_bytes = [], 0
        for batch in batches:
            for at in batch["at"]:
                with store.open_input_file(base + at) as file:
                    content = file.read()
                encoding = json.detect_encoding(content)
                rows.append((at, content if encoding == "utf-8" else content.decode(encoding, "replace").encode()))
                n_bytes += len(content)
                if n_bytes >= _BATCH_BYTES:
                    yield pd.DataFrame(rows, columns=["at", "content"])
                    rows, n_bytes = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=["at", "content"])

    tasks = ceil(((total["bytes"] or 0) + total["n"] * OPEN_BYTES) / _TASK_BYTES)
    dealt = files.select("at").repartition(max(tasks, spark.sparkContext.defaultParallelism), "at")
    return dealt.mapInPandas(read, "at string, content binary")


def _streamed_pages(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Records by Spark's reader: its index of files is on the driver."""
    reader = small_files(spark).read.schema(schemas.BLOCK_RECORD).option("multiLine", "true")
    rows = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").json(paths)
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return rows.withColumn("document", _path_part(path, 2))


def read_block_pages(spark: SparkSession, root: str) -> DataFrame:
    """Block records of ``root/document/page_*.json`` files, each a JSON list.

    Tasks list the folders and read the files, so that the driver has no index of them. Where pyarrow does not
    know the store, Spark's reader reads them all, and the driver holds their index.
    """
    if not _known_store(root):
        return _streamed_pages(spark, root)
    files = _files_below(spark, root, ".json")
    small, large = files.filter(F.col("length") <= WHOLE_BYTES), files.filter(F.col("length") > WHOLE_BYTES)
    contents = _contents(spark, root, small, small.agg(F.count("*").alias("n"), F.sum("length").alias("bytes")).first())
    text = F.col("content").cast("string")
    listed = F.from_json(text, T.ArrayType(schemas.BLOCK_RECORD))
    # What is no JSON is a record without fields, as for Spark's reader; a file without a character has none.
    none = F.array(F.lit(None).cast(schemas.BLOCK_RECORD))
    records = F.explode(F.when(text.rlike(r"[^ \t\r\n]"), F.coalesce(listed, none))).alias("record")
    document = _path_part(F.concat(F.lit(root.rstrip("/")), "at"), 2).alias("document")
    pages = contents.select("at", records).select("record.*", document)
    paths = [root.rstrip("/") + re.sub(r"([\[\]{}*?\\])", r"\\\1", r["at"]) for r in large.select("at").collect()]
    return pages.unionByName(_streamed_pages(spark, paths)) if paths else pages


def read_block_table(spark: SparkSession, root: str) -> DataFrame:
    """Block records written by :func:`corpusflow.sources.writers.write_blocks`."""
    keys = [T.StructField("document", T.StringType())]
    return spark.read.schema(T.StructType([*schemas.BLOCK_RECORD.fields, *keys])).json(root)


def read_block_store(spark: SparkSession, root: str, document: str | None = None) -> DataFrame:
    """Block records written by :func:`corpusflow.sources.writers.write_block_store`, of one document or of all."""
    schema = T.StructType([*schemas.BLOCK_RECORD.fields, T.StructField("document", T.StringType())])
    records = spark.read.schema(schema).parquet(root)
    return records.filter(F.col("document") == document) if document is not None else records


def read_fetched(spark: SparkSession, path: str) -> DataFrame:
    """Fetched objects stored as ``(url, content_type, body)``."""
    return spark.read.schema("url string, content_type string, body binary").parquet(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landing pages stored as ``(page_id, url, html)``."""
    return spark.read.parquet(path).select("page_id", "url", "html")
