"""Quality rules on lines that many documents of a host share.

Normalised lines are hashed, and the distinct documents of each host that hold a line are
counted. Lines over the limit are removed; a document that loses most of its text is rejected,
as is one that fails the base rules on its own words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from corpusflow.session import stored

SEED = 42
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\f\r"
MIN_WORDS, REPEAT_PERCENT = 50, 50
#: A line is removed if more documents of its host hold it than this number or this share.
MIN_DOCUMENTS, HOST_SHARE = 50, 0.05
#: The share counts in more documents than this: in a few documents a line is shared by chance.
FEW_DOCUMENTS = 5
#: A document is rejected if it loses more than this share of the characters of its words.
DEPLETED = 0.8

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words that stand in a window of ``width`` words found twice or more."""
    if len(words) <= width:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    window = ids[: len(ids) - width + 1]
    for k in range(1, width):
        pairs = window * len(numbers) + ids[k : len(ids) - width + 1 + k]
        _, window, times = np.unique(pairs, return_inverse=True, return_counts=True)
    covered = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(times[window] > 1)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + width, -1)
    return int((np.cumsum(covered) > 0).sum())


def measures(text: str | None) -> tuple:
    """Word count, characters, symbols, repeated lines, repeated words; lines and their characters."""
    text = text or ""
    words: list[bytes] = []
    seen: set[str] = set()
    own: dict[int, int] = {}
    n_lines = 0
    for line in text.split("\n"):
        found = line.encode().split()
        if found:
            n_lines += 1
            seen.add(line)
            words += found
            joined = b" ".join(found)
            key = xxhash.xxh64_intdigest(joined.lower(), SEED)
            chars = len(joined.decode()) - len(found) + 1
            own[key] = own.get(key, 0) + chars
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        n_lines - len(seen),
        repeated_words(words),
        np.fromiter(own, np.uint64, len(own)).view(np.int64),
        list(own.values()),
    )


_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = list(zip(*(measures(t.as_py()) for t in batch.column(3)))) or [()] * 7
        arrays = [batch.column(0), batch.column(1), batch.column(2), *(pa.array(x, pa.int64()) for x in found[:5])]
        arrays += [pa.array(x, pa.list_(pa.int64())) for x in found[5:]]
        names = ["doc_id", "host", "text_key", *_MEASURES, "lines", "chars"]
        yield pa.RecordBatch.from_arrays(arrays, names=names)


def line_key(line: Column) -> Column:
    """The hash of a normalised line, as the rules count it."""
    words = F.trim(F.regexp_replace(F.translate(line, _UPPER, _LOWER), r"[\x20\x09-\x0D]+", " "))
    return F.xxhash64(words)


def judge(docs: DataFrame, host: str = "source") -> DataFrame:
    """Measures and verdicts of each whole text, with the hashes of the lines to remove.

    ``doc_id, host, text_key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    removed_chars, removed, base_failed, kept``. Texts that are equal count as one document of
    their host; rows without a host share one. One row per input row, repeated rows and NULL
    ids included; NULL texts count as empty and fail the base rules. An empty table gives no
    rows; other columns are ignored.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(
        "doc_id", F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), F.xxhash64("text").alias("text_key"), "text"
    )
    numbers = ", ".join(f"{name} long" for name in _MEASURES)
    schema = f"doc_id {kind}, host string, text_key long, {numbers}, lines array<long>, chars array<long>"
    found = rows.mapInArrow(_measured, schema).withColumn("row", F.monotonically_increasing_id())
    found = stored(found, "measures")

    lines = found.select("row", "host", "text_key", F.explode(F.arrays_zip("lines", "chars")).alias("l")).select(
        "row", "host", "text_key", F.col("l.lines").alias("line"), F.col("l.chars").alias("chars")
    )
    counts = lines.groupBy("host", "line").agg(F.count_distinct("text_key").alias("n"))
    counts = counts.filter(F.col("n") > min(MIN_DOCUMENTS, FEW_DOCUMENTS))
    sizes = found.groupBy("host").agg(F.count_distinct("text_key").alias("documents"))
    share = (F.col("n") > FEW_DOCUMENTS) & (F.col("n") > HOST_SHARE * F.col("documents"))
    frequent = counts.join(sizes, "host").filter((F.col("n") > MIN_DOCUMENTS) | share).select("host", "line")
    lost = (
        lines.join(frequent, ["host", "line"])
        .groupBy("row")
        .agg(F.sum("chars").alias("removed_chars"), F.sort_array(F.collect_list("line")).alias("removed"))
    )
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    judged = found.drop("lines", "chars").join(lost, "row", "left").drop("row")
    judged = judged.withColumns(
        {
            "removed_chars": F.coalesce("removed_chars", F.lit(0)),
            "removed": F.coalesce("removed", F.array().cast("array<long>")),
            "base_failed": base_failed,
        }
    )
    return judged.withColumn(
        "kept", ~F.col("base_failed") & (F.col("removed_chars") <= DEPLETED * F.col("word_chars"))
    )


def clean(docs: DataFrame, host: str = "source") -> DataFrame:
    """The kept documents, all columns, without the removed lines.

    ``n_chars``, if there, follows the text. Rows are told apart by id, host and text, so
    repeated rows share their verdict and all stay.
    """
    keys = ["doc_id", "host", "text_key"]
    verdicts = judge(docs, host).filter("kept").select(F.struct(*keys).alias("_key"), "removed").dropDuplicates(["_key"])
    key = F.struct(
        F.col("doc_id"), F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), F.xxhash64("text").alias("text_key")
    )
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), key.alias("_own"))
    text = F.col("_row.text")
    rest = F.array_join(F.filter(F.split(text, "\n"), lambda l: ~F.array_contains("removed", line_key(l))), "\n")
    text = F.when(F.size("removed") > 0, rest).otherwise(text)
    joined = rows.join(verdicts, F.col("_own").eqNullSafe(F.col("_key"))).select("_row", text.alias("_text"))
    new = {"text": F.col("_text"), "n_chars": F.char_length("_text").cast("long")}
    return joined.select(*[new.get(c, F.col("_row")[c]).alias(c) for c in docs.columns])
