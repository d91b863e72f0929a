"""Whole run over stored parser replies: block records and the outcome of each page and document."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from corpusflow.functions.boxes import CANVAS
from corpusflow.operators import blocks
from corpusflow.sources import responses


@dataclass(frozen=True)
class LayoutRun:
    records: DataFrame
    pages: DataFrame
    documents: DataFrame


def parse(replies: DataFrame, canvas: tuple[int, int] = CANVAS, documents: DataFrame | None = None) -> LayoutRun:
    """``replies(document, page, response)`` decoded, recorded and counted."""
    found = responses.decode(replies)
    pages = blocks.page_results(replies.select("document", "page"), found)
    return LayoutRun(blocks.records(found, canvas), pages, blocks.document_results(pages, documents))
