"""Stored replies of the page parser as block rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusflow.functions.boxes import DEFAULT_TYPE
from corpusflow.schemas import BBOX

_ARGUMENTS = "$.choices[0].message.tool_calls[0].function.arguments"
_ENTRY = "map<string,string>"
_STRICT = {"allowSingleQuotes": "false", "allowUnquotedFieldNames": "false"}


def blocks_of(arguments: Column) -> Column:
    """Array of block entries in a tool call's arguments, empty when they are not one JSON list.

    The list may be wrapped in one more list, whose first entry then counts.
    """
    listed = F.when(F.ltrim(arguments).startswith("["), arguments)
    wrapped = F.regexp_like(listed, F.lit(r"^\s*\[\s*\["))

    def read(text: Column, kind: str) -> Column:
        # Between two fields: a parser stops at the end of a list and does not see what follows it.
        framed = F.concat(F.lit('{"_list":'), text, F.lit(',"_end":true}'))
        entries = F.from_json(framed, f"_list {kind}, _end boolean", _STRICT)
        return F.when(entries["_end"], entries["_list"])

    inner = F.get(read(F.when(wrapped, listed), f"array<array<{_ENTRY}>>"), F.lit(0))
    flat = read(F.when(~wrapped, listed), f"array<{_ENTRY}>")
    return F.coalesce(inner, flat, F.array().cast(f"array<{_ENTRY}>"))


def decode(responses: DataFrame, response: str = "response") -> DataFrame:
    """One row per block of the first tool call of the first choice; absent type and text get their defaults, explicit nulls stay."""
    keep = [c for c in responses.columns if c != response]
    block = F.col("_block")

    def field(name: str, default: str) -> Column:
        return F.when(F.map_contains_key(block, name), F.try_element_at(block, F.lit(name))).otherwise(F.lit(default))

    replies = responses.select(*keep, F.get_json_object(response, _ARGUMENTS).alias("_arguments"))
    rows = replies.select(*keep, F.posexplode(blocks_of(F.col("_arguments"))).alias("block_id", "_block"))
    return rows.select(
        *keep,
        "block_id",
        field("type", DEFAULT_TYPE).alias("type"),
        field("text", "").alias("text"),
        F.from_json(F.try_element_at(block, F.lit("bbox")), BBOX.simpleString()).alias("bbox"),
    )
