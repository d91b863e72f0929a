"""Extraction archives: the structured JSON inside each ZIP."""

from __future__ import annotations

import io
import json
import math
import zipfile
from collections.abc import Iterator
from typing import IO

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusflow.schemas import ARCHIVE
from corpusflow.session import small_files
from corpusflow.sources.samples import list_files, opened

# Fixed value: archive member with the extracted structure.
MEMBER = "structuredData.json"
#: Bytes of archives that one task opens.
BYTES_PER_TASK = 128 * 1024 * 1024
#: Characters of members that a task holds before it passes them on.
CHARS_PER_TABLE = 1024 * 1024
#: Tasks of fewer bytes than that, on request, for each core.
TASKS_PER_CORE = 16


def read_archives(spark: SparkSession, root: str) -> DataFrame:
    """ZIP files below ``root`` as ``(document, content)``."""
    files = (
        small_files(spark)
        .read.format("binaryFile")
        .option("pathGlobFilter", "*.zip")
        .option("recursiveFileLookup", "true")
        .load(root)
    )
    return files.select(_document(), "content")


def _document() -> Column:
    """The file's name without its ending."""
    return F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.zip$", "").alias("document")


def _member(file: IO[bytes]) -> tuple[str, str | None]:
    """Status and text of the member: an archive without it is in order, an unreadable one is not."""
    try:
        with zipfile.ZipFile(file) as archive:
            if MEMBER not in archive.namelist():
                return "no_member", None
            data = archive.read(MEMBER)
    except Exception:  # damaged in any way: the archive's own failure, not the job's
        return "bad_zip", None
    try:
        text = data.decode("utf-8")
        json.loads(text)
    except (ValueError, RecursionError):
        return "bad_json", None
    return "ok", text


_STRUCTURED = "document string, status string, json string"


def structured_json(archives: DataFrame) -> DataFrame:
    """``(document, status, json)`` per archive; status is ok, no_member, bad_zip or bad_json, json NULL unless ok."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [_member(io.BytesIO(content or b"")) for content in batch["content"]]
            status, text = ([f[i] for f in found] for i in (0, 1))
            yield pd.DataFrame({"document": batch["document"], "status": status, "json": text}, dtype=object)

    return archives.select("document", "content").mapInPandas(unpack, _STRUCTURED)


def read_structured(spark: SparkSession, root: str, bytes_per_task: int = BYTES_PER_TASK) -> DataFrame:
    """``structured_json`` of the ZIP files below ``root``, of which only directory and member are read.

    Files are dealt to as many tasks as their bytes need; small tasks are no more than 16 for each core. One archive is open at a time, and an
    archive's pages and pictures are never in memory, whatever its size.
    """
    files = list_files(spark, root, "*.zip").select(_document(), "path", "length")
    total = files.agg(F.sum("length").alias("n")).first()["n"] or 0

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, size = [], 0
            for document, path in zip(batch["document"], batch["path"]):
                with opened(path) as file:
                    rows.append((document, *_member(file)))
                size += len(rows[-1][2] or "")
                if size >= CHARS_PER_TABLE:
                    yield pd.DataFrame(rows, columns=["document", "status", "json"], dtype=object)
                    rows, size = [], 0
            yield pd.DataFrame(rows, columns=["document", "status", "json"], dtype=object)

    most = max(TASKS_PER_CORE * spark.sparkContext.defaultParallelism, math.ceil(total / BYTES_PER_TASK))
    dealt = files.select("document", "path").repartition(max(1, min(most, math.ceil(total / bytes_per_task))))
    return dealt.mapInPandas(unpack, _STRUCTURED)


def parsed(structured: DataFrame) -> DataFrame:
    """Parsed archives ``(document, ok, status, elements)``; those without the member are ok, with no elements."""
    rows = structured.withColumn("_data", F.from_json("json", ARCHIVE))
    ok = F.col("status").isin("ok", "no_member")
    return rows.select("document", ok.alias("ok"), "status", F.col("_data.elements").alias("elements"))


def elements(archives: DataFrame) -> DataFrame:
    """``parsed`` archives of a table with their contents."""
    return parsed(structured_json(archives))
