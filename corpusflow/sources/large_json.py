"""Embedding JSON files of any size, each read by many tasks.

A file is cut into byte ranges. Whether a range begins inside a string, and how deep, depends on
all bytes before it, so a first scan gives each range's effect for both cases, and a running sum
over the ranges of a file settles them. A second scan finds the members of the top objects, a
third the items that begin in each range, which are read on beyond its end where need be.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from corpusflow import schemas
from corpusflow.session import stored
from corpusflow.sources.samples import TEXT_CHARS, listing, opened

RANGE_BYTES = 32 << 20
_QUOTE, _BACKSLASH = ord('"'), ord("\\")


def _read(file, start: int, size: int) -> bytes:
    file.seek(start)
    return file.read(size)


def _escaped_at(file, start: int) -> bool:
    """Whether an odd number of backslashes precedes the byte at ``start``."""
    run = 0
    while run < start:
        size = min(1024, start - run)
        before = _read(file, start - run - size, size)
        left = before.rstrip(b"\\")
        run += len(before) - len(left)
        if left:
            break
    return run % 2 == 1


def _quotes(data: np.ndarray, escaped: bool) -> np.ndarray:
    """Places of the quotes that begin or end a string."""
    at = np.arange(len(data))
    other = np.maximum.accumulate(np.where(data != _BACKSLASH, at, -1))
    quotes = np.flatnonzero(data == _QUOTE)
    before = np.where(quotes > 0, other[quotes - 1], -1)
    run = quotes - 1 - before + (escaped & (before < 0))
    return quotes[run % 2 == 0]


def _brackets(data: np.ndarray, quotes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of brackets, +1 or -1, and whether an even number of quotes precedes them."""
    opening = (data == ord("{")) | (data == ord("["))
    at = np.flatnonzero(opening | (data == ord("}")) | (data == ord("]")))
    return at, np.where(opening[at], 1, -1), np.searchsorted(quotes, at) % 2 == 0


def _effects(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for path, start, stop in zip(batch["path"], batch["start"], batch["stop"]):
            with opened(path) as file:
                data = np.frombuffer(_read(file, start, stop - start), np.uint8)
                escaped = _escaped_at(file, start)
                if start == 0 and not data.tobytes().lstrip().startswith(b"{"):
                    raise ValueError(f"{path} does not begin with an object")
            quotes = _quotes(data, escaped)
            _, steps, even = _brackets(data, quotes)
            rows.append((path, start, stop, escaped, len(quotes) % 2, int(steps[even].sum()), int(steps[~even].sum())))
        yield pd.DataFrame(rows, columns=["path", "start", "stop", "escaped", "odd", "outside", "inside"])


class _Range:
    """The places in a range that lie outside strings, with their depths."""

    def __init__(self, data: bytes, escaped: bool, in_string: int, depth: int):
        self.data = np.frombuffer(data, np.uint8)
        self.quotes = _quotes(self.data, escaped)
        at, steps, even = _brackets(self.data, self.quotes)
        real = even != bool(in_string)
        self.at, self.after = at[real], depth + np.cumsum(steps[real])
        self.before = self.after - steps[real]
        self.first = depth
        self.opening = self.quotes[in_string::2]  # a string that began before ends with the first

    def objects(self, depth: int) -> np.ndarray:
        """Places in ``at`` of the objects that begin at ``depth``."""
        return np.flatnonzero((self.before == depth) & (self.data[self.at] == ord("{")))

    def strings(self, depth: int) -> list[int]:
        found = np.searchsorted(self.at, self.opening)
        depths = np.concatenate([[self.first], self.after])[found]
        return self.opening[depths == depth].tolist()


def _parsed(file, start: int, length: int) -> tuple[str, str | None] | None:
    """The member that begins with the string at ``start`` and its value's text; arrays are left unread."""
    size, decode = 4096, json.JSONDecoder(strict=False).raw_decode
    while True:
        text = _read(file, start, size).decode(errors="replace")
        whole = start + size >= length
        try:
            key, end = decode(text)
            rest = text[end:].lstrip()
            if rest and rest[0] != ":":
                return None
            value = rest[1:].lstrip()
            if value.startswith("["):
                return key, None
            _, end = decode(value)
            if whole or end < len(value):
                return key, value[:end]
        except ValueError:
            pass
        if whole:
            return None
        size *= 4


def _members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Top objects (no key) and their members, by place."""
    for batch in batches:
        rows = []
        for r in batch.itertuples():
            with opened(r.path) as file:
                found = _Range(_read(file, r.start, r.stop - r.start), r.escaped, r.in_string, r.depth)
                rows += [(r.path, r.start + int(at), None, None) for at in found.at[found.objects(0)]]
                for at in found.strings(1):
                    member = _parsed(file, r.start + at, r.length)
                    if member:
                        rows.append((r.path, r.start + at, *member))
        yield pd.DataFrame(rows, columns=["path", "at", "key", "value"], dtype=object)


def _last(file, start: int, size: int, length: int) -> bytes:
    """The object that begins at ``start`` and does not end within ``size`` bytes."""
    while True:
        size *= 2
        data = _read(file, start, size)
        found = _Range(data, False, 0, 0)
        ends = found.at[found.after == 0]
        if len(ends):
            return data[: ends[0] + 1]
        if start + size >= length:
            return data


def _items(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts of the items that begin in each range, with the metadata of their object."""
    for batch in batches:
        for r in batch.itertuples():
            rows = []
            with opened(r.path) as file:
                data = _read(file, r.start, r.stop - r.start)
                found = _Range(data, r.escaped, r.in_string, r.depth)
                closing = found.at[found.after == 2]
                spans = sorted((s["first"], s["last"], s["metadata"]) for s in r.spans)
                firsts = np.array([s[0] for s in spans])
                for at in found.at[found.objects(2)].tolist():
                    span = int(np.searchsorted(firsts, r.start + at, "right")) - 1
                    if span < 0 or r.start + at >= spans[span][1]:
                        continue
                    end = int(np.searchsorted(closing, at))
                    if end < len(closing):
                        text = data[at : closing[end] + 1]
                    else:
                        text = _last(file, r.start + at, len(data) - at, r.length)
                    rows.append((text.decode(errors="replace"), spans[span][2]))
            yield pd.DataFrame(rows, columns=["item", "metadata"], dtype=object)


def read_large_embedding_json(spark: SparkSession, root: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The rows of :func:`corpusflow.sources.samples.read_embedding_json`, a task for each byte range.

    ``root`` is a folder of UTF-8 ``*.json`` files, each one object or several one after the other, on
    one line or many. A file that begins with anything else fails. The bytes are read three times.
    """
    files = listing(spark, root, "*.json").filter("length > 0")
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long")))
    ranges = stored(files.select("path", "length", starts.alias("start")), "ranges")
    ranges = ranges.withColumn("stop", F.least(F.col("start") + range_bytes, "length"))
    # Tasks hold one range at a time: small ones share a task, if there are enough for all cores.
    size = ranges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("stop") - F.col("start")).alias("length")).first()
    least = max(4 * spark.sparkContext.defaultParallelism, math.ceil((size["length"] or 0) / RANGE_BYTES))
    tasks = max(1, min(size["n"], least))
    kind = "path string, start long, stop long, escaped boolean, odd int, outside long, inside long"
    effects = stored(ranges.repartition(tasks).mapInPandas(_effects, kind), "effects")

    preceding = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    in_string = F.coalesce(F.sum("odd").over(preceding) % 2, F.lit(0)).cast("int")
    states = effects.withColumn("in_string", in_string)
    change = F.when(F.col("in_string") == 0, F.col("outside")).otherwise(F.col("inside"))
    states = states.withColumn("change", change).withColumn("depth", F.coalesce(F.sum("change").over(preceding), F.lit(0)))
    states = states.join(ranges.select("path", "start", "length"), ["path", "start"])
    states = stored(states.select("path", "start", "stop", "length", "escaped", "in_string", "depth"), "states")

    kind = "path string, at long, key string, value string"
    members = stored(states.repartition(tasks).mapInPandas(_members, kind), "members")
    order = Window.partitionBy("path").orderBy("at")
    members = members.withColumns({"object": F.count(F.when(F.col("key").isNull(), 1)).over(order), "last": F.lead("at").over(order)})
    listed = (F.col("key") == "embeddings") & F.col("value").isNull()
    spans = members.groupBy("path", "object").agg(
        F.max(F.when(listed, F.col("at"))).alias("first"),
        F.max(F.when(listed, F.coalesce("last", F.lit((1 << 63) - 1)))).alias("last"),
        F.max_by("value", F.when(F.col("key") == "metadata", F.col("at"))).alias("metadata"),
    )
    # Each range that a span meets, not each range and span of a file.
    spans = spans.filter("first IS NOT NULL").join(ranges.filter("start = 0").select("path", "length"), "path")
    n = f"{int(range_bytes)}L"
    met = F.expr(f"explode(sequence(first div {n} * {n}, (least(last, length) - 1) div {n} * {n}, {n})) AS start")
    within = states.join(spans.select("path", "first", "last", "metadata", met), ["path", "start"]).groupBy(*states.columns)
    within = within.agg(F.collect_list(F.struct("first", "last", "metadata")).alias("spans"))
    items = within.repartition(tasks).mapInPandas(_items, "item string, metadata string")

    fields = {f.name: f.dataType for f in schemas.EMBEDDING_JSON}
    parsed = items.select(
        F.from_json("item", fields["embeddings"].elementType).alias("e"),
        F.from_json("metadata", fields["metadata"]).alias("metadata"),
    )
    text = F.substring("e.text", 1, TEXT_CHARS).alias("text")
    return parsed.filter(F.col("e.embedding").isNotNull()).select("e.embedding", "e.split", text, "e.dataset", "metadata")
