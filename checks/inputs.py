"""Inputs of the registered queries, derived by Spark from the given tables."""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusflow.operators.encode import TokenHashEncoder
from corpusflow.session import fresh_path
from corpusflow.sources.archives import MEMBER

# Labels that the page parser gives.
BLOCK_TYPES = (
    "Text", "Section-header", "List-item", "Picture", "Caption", "Page-footer",
    "Page-header", "Title", "Table", "TOC", "Footnote",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as samples: the source is the dataset, the language gives the split."""
    split = F.when(F.col("lang") == "en", "chat").otherwise(F.concat(F.lit("multilingual_"), "lang"))
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("dataset"), split.alias("split"), "doc_id", "text"
    )


def some_blank(rows: DataFrame) -> DataFrame:
    """Every 13th text missing, the next one white space."""
    text = F.when(F.expr("doc_id % 13 = 0"), None).when(F.expr("doc_id % 13 = 1"), " \n ").otherwise(F.col("text"))
    return rows.withColumn("text", text)


def unnamed(rows: DataFrame) -> DataFrame:
    """Every 5th row without a split, every 7th without a dataset."""
    return rows.withColumn("split", F.expr("if(doc_id % 5 = 0, NULL, split)")).withColumn(
        "dataset", F.expr("if(doc_id % 7 = 0, NULL, dataset)")
    )


def known_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry made of the sources, a never downloaded twin of each included."""
    source = table(spark, sf_dir, "documents").select("source").distinct()
    twin = F.explode(F.array("source", F.concat("source", F.lit("-next")))).alias("dataset")
    return source.select(twin, "source").select(
        "dataset",
        F.concat(F.lit("hub/"), "dataset").alias("source_name"),
        F.lit(None).cast("string").alias("config"),
        F.concat(F.lit("staged/"), "dataset").alias("subdir"),
        F.when(F.col("dataset").endswith("-next"), "next").otherwise("now").alias("grp"),
    )


def specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source one good and four faulty specs, and one for each split present."""
    source = table(spark, sf_dir, "documents").select("source").distinct()
    made = F.array(
        F.concat("source", F.lit(":chat")),
        F.col("source"),
        F.concat(F.lit("no-"), "source", F.lit(":chat")),
        F.concat("source", F.lit("-next:chat")),
        F.concat("source", F.lit(":code:main")),
    )
    return source.select(F.explode(made).alias("spec"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as lists of messages, some contents missing."""
    content = F.when((F.col("conv_id") + F.col("turn")) % 17 != 0, F.col("text"))
    turn = F.struct("turn", "role", content.alias("content"))
    return (
        table(spark, sf_dir, "conversations")
        .groupBy("conv_id")
        .agg(F.array_sort(F.collect_list(turn)).alias("turns"))
        .select(
            "conv_id",
            F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"))).alias(
                "messages"
            ),
        )
    )


def vector_tree(spark: SparkSession, sf_dir: str, broken: bool = False) -> DataFrame:
    """Vectors as rows of embedding files; on request with NaN, infinities and short vectors."""
    vector = F.col("embedding").cast("array<double>")
    if broken:
        at = F.col("vec_id") % 50
        first = (
            F.when(at == 7, F.lit(float("nan")))
            .when(at == 8, F.lit(float("inf")))
            .when(at == 9, F.lit(float("-inf")))
        )
        swapped = F.concat(F.array(first), F.slice(vector, 2, 63))
        vector = F.when(first.isNotNull(), swapped).when(at == 10, F.slice(vector, 1, 32)).otherwise(vector)
    dataset = F.concat(F.lit("d"), F.col("vec_id") % 3)
    split = F.concat(F.lit("s"), "label")
    return table(spark, sf_dir, "embeddings").select(
        dataset.alias("dataset"),
        split.alias("split"),
        F.concat(dataset, F.lit("-"), split).alias("file"),
        F.lit(1000 * 1000 * 1000).alias("file_size"),
        vector.alias("embeddings"),
        F.col("vec_id").alias("original_index"),
    )


def _coordinate(a: int, b: int) -> Column:
    """A hundredth between -0.10 and 1.19 that depends on page and block."""
    return ((F.col("page") * a + F.col("block_id") * b) % 130 - 10) / F.lit(100.0)


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One layout block per line of a document; a page fails where it has no blocks."""
    kinds = F.array(*[F.lit(t) for t in BLOCK_TYPES])
    lines = table(spark, sf_dir, "documents").select(
        F.col("source").alias("document"),
        F.col("doc_id").cast("int").alias("page"),
        F.posexplode(F.split("text", "\n")).alias("block_id", "text"),
    )
    kind = F.when(F.col("block_id") % 7 != 0, F.get(kinds, F.col("block_id") % 11))
    bbox = F.struct(
        _coordinate(37, 11).alias("xmin"),
        _coordinate(41, 13).alias("ymin"),
        _coordinate(53, 29).alias("xmax"),
        _coordinate(59, 31).alias("ymax"),
    )
    return lines.select("document", "page", "block_id", kind.alias("type"), "text", bbox.alias("bbox"))


def parsed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("document"), F.col("doc_id").cast("int").alias("page")
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parser replies per page in six shapes; the block list holds the page's lines."""
    line = F.transform(
        F.split("text", "\n"),
        lambda t, i: F.struct(
            F.when(i % 7 != 0, F.concat(F.lit("T"), i % 11)).alias("type"),
            F.when(i % 5 != 0, t).alias("text"),
            F.struct((i / F.lit(100.0)).alias("xmin")).alias("bbox"),
        ),
    )
    listed = F.to_json(line)
    shape = F.col("doc_id") % 6
    arguments = (
        F.when(shape == 0, listed)
        .when(shape == 1, F.concat(F.lit("["), listed, F.lit("]")))
        .when(shape == 2, F.lit("[]"))
        .when(shape == 3, F.lit('{"type": "Text"}'))
        .when(shape == 4, F.concat(F.lit("["), listed))
    )
    call = F.struct(F.struct(arguments.alias("arguments")).alias("function"))
    calls = F.when(shape == 5, F.array().cast("array<struct<function:struct<arguments:string>>>")).otherwise(F.array(call))
    reply = F.struct(F.array(F.struct(F.struct(calls.alias("tool_calls")).alias("message"))).alias("choices"))
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("page"), F.to_json(reply).alias("response")
    )


def archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ZIP per document; its elements are the lines.

    Of ten, one lacks the member and three are broken: no ZIP, no whole JSON, a damaged stream.
    """

    def zipped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        endings = ("/P", "/P[2]", "/Table", None)
        for batch in batches:
            contents = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                found = [
                    {"Text": line} | ({"Path": f"//Document{endings[i % 4]}"} if endings[i % 4] else {})
                    for i, line in enumerate(text.split("\n"))
                ]
                buffer = io.BytesIO()
                with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                    name = "other.json" if doc_id % 10 == 0 else MEMBER
                    archive.writestr(name, json.dumps({"elements": found})[: 14 if doc_id % 10 == 2 else None])
                content = bytearray(buffer.getvalue())
                if doc_id % 10 == 3:
                    start = 30 + len(MEMBER)  # behind the member's header
                    content[start : start + 20] = b"\xff" * 20
                contents.append(b"no zip" if doc_id % 10 == 1 else bytes(content))
            yield pd.DataFrame({"document": batch["doc_id"].astype(str), "content": contents})

    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    return rows.mapInPandas(zipped, "document string, content binary")


class Faulty:
    """Factory of an encoder that gives one vector too few, one number too many or none that is finite.

    Which one follows from the number of characters: 11, 13 or 17 divides it.
    """

    cache_key, dim = "faulty", 16

    def __call__(self):
        encoder = TokenHashEncoder()

        def encode(texts):
            found = encoder(texts)
            found[[len(text) % 17 == 0 for text in texts]] = np.nan
            if any(len(text) % 13 == 0 for text in texts):
                found = np.hstack([found, found[:, :1]])
            return found[1:] if any(len(text) % 11 == 0 for text in texts) else found

        return encode


class Choosy:
    """Factory of an encoder that refuses texts whose number of characters 97 divides."""

    cache_key = "choosy"

    def __call__(self):
        encoder = TokenHashEncoder()

        def encode(texts):
            if any(len(text) % 97 == 0 for text in texts):
                raise ValueError("refused")
            return encoder(texts)

        return encode


# Landing page additions by page_id % 8, shared with the SQL counterparts.
LANDING = {
    0: '<script>window.__PATHFACTORY__ = {"global":{"currentContent":{"sourceUrl":"https://a.example/p{id}.pdf"}}};</script>',
    1: '<script>window.__PATHFACTORY__={"global":{"currentContent":{},"experienceContent":['
    '{"title":"Guide","sourceUrl":"https://a.example/guide"},{"title":"Card DataSheet"},'
    '{"title":"Big DATASHEET {id}","sourceUrl":"https://x.widen.net/s/{id}"}]}};</script>',
    2: '<script>window.__PATHFACTORY__ = {"global": broken};</script>'
    '<iframe class="v" src="https://x.widen.net/v/{id}?a=1&amp;b=2"></iframe>',
    3: '<iframe src="https://other.example/{id}"></iframe><IFRAME width="9" src="https://y.widen.net/f/{id}"></IFRAME>',
    4: '<div class="d" data-source-url="https://a.example/d/{id}.pdf">x</div>',
    5: "",
    6: '<!-- <iframe src="https://x.widen.net/old/{id}"></iframe> --><iframe title="a > b" src=https://x.widen.net/u/{id}></iframe>',
    7: '<iframe src="https://x.widen.net/it\'s/{id}?a&#x26;b"></iframe>',
}


def landing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages with the link marks of landing pages added."""
    extra = F.lit("")
    for rest, mark in LANDING.items():
        filled = F.replace(F.lit(mark), F.lit("{id}"), F.col("page_id").cast("string"))
        extra = F.when(F.col("page_id") % len(LANDING) == rest, filled).otherwise(extra)
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", "url", F.concat("html", extra).alias("html"))


def viewer_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as viewer pages.

    Of five, one has no anchor but the viewer's own link, two have a download link, one of them
    with a path to be resolved.
    """
    bare = F.concat(
        F.replace("html", F.lit('href="'), F.lit('ref="')), F.lit("<script>var viewerPdfUrl = '/v/"), "page_id", F.lit("';</script>")
    )
    kind = F.col("page_id") % 5
    extra = F.when(kind == 1, '<a href="/content/p{id}/../q.pdf?u={id}&amp;download=true">').when(
        kind == 2, '<a href="/content/p{id}.pdf?download=true">'
    )
    filled = F.replace(F.coalesce(extra, F.lit("")), F.lit("{id}"), F.col("page_id").cast("string"))
    html = F.when(kind == 0, bare).otherwise(F.concat("html", filled))
    return table(spark, sf_dir, "pages").select("page_id", "url", html.alias("html"))


def fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as fetched objects of five content types, half of them PDF by their first bytes."""
    kind = F.col("page_id") % 5
    content_type = (
        F.when(kind == 0, "Application/PDF")
        .when(kind == 1, "text/html; charset=utf-8")
        .when(kind == 2, "application/octet-stream")
        .when(kind == 3, "image/png")
        .otherwise("text/html")
    )
    url = F.when(kind == 4, F.concat("url", F.lit(".pdf"))).when(kind == 3, F.concat(F.lit("https://x.widen.net/"), "page_id"))
    body = F.concat(F.when(F.col("page_id") % 2 == 0, "%PDF-").otherwise(""), "html")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.coalesce(url, "url").alias("url"),
        content_type.alias("content_type"),
        body.cast("binary").alias("body"),
    )


def as_run_log(events: DataFrame) -> DataFrame:
    """Events as the log of a sharded run."""
    kind = F.col("event_type")
    status = (
        F.when(kind.isin("purchase", "signup"), "success")
        .when(kind == "view", "skipped")
        .when(kind == "click", "no_text")
        .otherwise("error")
    )
    stage = F.when(kind.isin("purchase", "signup"), "saving").when(kind == "view", "loading").otherwise("embedding")
    worker = F.col("user_id") % 8
    current = F.floor("value").cast("long")
    return events.select(
        (F.col("user_id") % 3).alias("run"),
        "ts",
        "event_id",
        worker.alias("worker"),
        status.alias("status"),
        current.alias("samples"),
        (1 + F.col("user_id") % 5).cast("double").alias("seconds"),
        stage.alias("stage"),
        F.concat(F.lit("corpus-with-a-long-name-"), "event_type", F.lit("-"), F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("filename"),
        current.alias("current"),
        (current + F.col("user_id") % 5 * 10).alias("total"),
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_run_log(table(spark, sf_dir, "events"))


def saved(files: DataFrame, name: str) -> str:
    """Write rows ``(path, content)`` as files below a new shared folder, and name the folder."""
    root = fresh_path(files.sparkSession, name)

    def save(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.fs as pafs

        store, base = pafs.FileSystem.from_uri(root)
        made = lru_cache(10_000)(store.create_dir)  # rows of many folders are mixed
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                made(f"{base}/{path}".rpartition("/")[0])
                with store.open_output_stream(f"{base}/{path}") as out:
                    out.write(content)
            yield pd.DataFrame({"n": [len(batch)]})

    files.select("path", F.col("content").cast("binary").alias("content")).mapInPandas(save, "n long").agg(F.sum("n")).collect()
    return root
