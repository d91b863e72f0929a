"""Layout blocks: records, previews, drawable boxes and roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusflow.functions import boxes
from corpusflow.functions.text import cut, one_line

# Fixed value: characters of text shown in a preview.
PREVIEW_CHARS = 200


def block_record(block: Column, page: Column, block_id: Column, width: int, height: int) -> Column:
    """Struct with clamped and ordered box, truncated pixels and validity."""
    box = boxes.ordered(boxes.corners(block["bbox"]))
    return F.struct(
        page.cast("int").alias("page"),
        block_id.cast("int").alias("block_id"),
        boxes.block_type(block["type"]).alias("type"),
        block["text"].alias("text"),
        boxes.struct_of(box).alias("bbox_normalized"),
        boxes.struct_of(boxes.scaled(box, width, height), "int").alias("bbox_pixels"),
        ((box["xmax"] > box["xmin"]) & (box["ymax"] > box["ymin"])).alias("is_valid"),
    )


def records(blocks: DataFrame, canvas: tuple[int, int] = boxes.CANVAS, carry: tuple[str, ...] = ("document",)) -> DataFrame:
    """Block rows ``(document, page, block_id, type, text, bbox)`` as records."""
    kept = [c for c in carry if c in blocks.columns]
    record = block_record(F.struct("type", "text", "bbox"), F.col("page"), F.col("block_id"), *canvas)
    return blocks.select(*kept, record.alias("_r")).select(*kept, "_r.*")


def preview(blocks: DataFrame, carry: tuple[str, ...] = ("document", "page")) -> DataFrame:
    """Block id, type, one line of text and the box as JSON."""
    text = cut(one_line(F.coalesce("text", F.lit(""))), PREVIEW_CHARS)
    return blocks.select(
        *[c for c in carry if c in blocks.columns],
        F.col("block_id").alias("id"),
        boxes.block_type(F.col("type")).alias("type"),
        text.alias("text"),
        F.coalesce(F.to_json("bbox"), F.lit("{}")).alias("bbox"),
    )


def drawable(blocks: DataFrame, canvas: tuple[int, int] = boxes.CANVAS, carry: tuple[str, ...] = ("document", "page")) -> DataFrame:
    """Blocks large enough to draw, with float pixel box and label; edges are not swapped."""
    box = boxes.corners(F.col("bbox"))
    pixels = boxes.scaled(box, *canvas)
    label = F.concat(F.col("block_id").cast("string"), F.lit(": "), boxes.block_type(F.col("type")))
    return blocks.filter(boxes.drawable(box, pixels)).select(
        *[c for c in carry if c in blocks.columns],
        "block_id",
        *[c.alias(n) for n, c in pixels.items()],
        label.alias("label"),
    )


def with_class(blocks: DataFrame, classes: DataFrame) -> DataFrame:
    """Blocks with the columns of ``classes(type, …)``; unknown and missing types take those of the default class.

    ``type`` must be unique in ``classes``; the block keeps the type it has.
    """
    extra = [c for c in classes.columns if c != "type"]
    known = classes.select(F.col("type").alias("_class"), *extra)
    named = blocks.join(known.select(F.col("_class").alias("_known")), boxes.block_type(F.col("type")) == F.col("_known"), "left")
    return (
        named.withColumn("_class", F.coalesce("_known", F.lit(boxes.DEFAULT_TYPE)))
        .join(known, "_class", "left")
        .select(*blocks.columns, *extra)
    )


def page_results(pages: DataFrame, blocks: DataFrame) -> DataFrame:
    """Blocks per page of ``pages(document, page)``; a page without blocks has failed."""
    counted = blocks.groupBy("document", "page").agg(F.count(F.lit(1)).alias("_blocks"))
    n = F.coalesce("_blocks", F.lit(0))
    return pages.join(counted, ["document", "page"], "left").select(
        "document", "page", n.cast("long").alias("blocks"), (n > 0).alias("ok")
    )


def document_results(results: DataFrame, documents: DataFrame | None = None) -> DataFrame:
    """Processed and total pages, blocks and success per document.

    Pass ``documents`` to report documents without pages too; those succeed with nothing done.
    """
    done = results.groupBy("document").agg(
        F.count_if("ok").alias("processed"),
        F.count(F.lit(1)).alias("total"),
        F.sum(F.when(F.col("ok"), F.col("blocks")).otherwise(0)).alias("blocks"),
    )
    if documents is not None:
        done = documents.select("document").distinct().join(done, "document", "left").na.fill(0)
    return done.withColumn("success", F.col("processed") == F.col("total"))


def run_totals(documents: DataFrame) -> DataFrame:
    return documents.agg(
        F.count(F.lit(1)).alias("documents"),
        F.count_if("success").alias("ok"),
        F.coalesce(F.sum("processed"), F.lit(0)).alias("processed"),
        F.coalesce(F.sum("total"), F.lit(0)).alias("pages"),
        F.coalesce(F.sum("blocks"), F.lit(0)).alias("blocks"),
    )


def element_counts(archives: DataFrame) -> DataFrame:
    """Elements, text elements and tables per archive; paths are tested by their last letters."""
    elements = F.coalesce("elements", F.array().cast(archives.schema["elements"].dataType))

    def ending(suffix: str) -> Column:
        return F.size(F.filter(elements, lambda e: F.coalesce(e["Path"].endswith(suffix), F.lit(False))))

    return archives.select(
        "document",
        F.size(elements).alias("elements"),
        ending("P").alias("text_n"),
        ending("Table").alias("table_n"),
    )


def extraction_totals(archives: DataFrame) -> DataFrame:
    """How many archives gave content and how many did not."""
    return archives.agg(F.count_if(F.col("ok")).alias("ok"), F.count_if(~F.col("ok")).alias("failed"))
