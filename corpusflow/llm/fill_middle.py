"""Fill-in-the-middle samples, cut at the boundaries of words.

A text's boundaries between units are a set of offsets in code points. The set is held the way
compressed bitmaps are: offsets share a container by their upper 16 bits, and a container is a
sorted array, a bitmap or a list of runs, whichever is smallest. Cumulative cardinalities over
the containers find the one that holds the k-th boundary, a select inside it gives the offset.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Percent of the texts that may be rearranged, and of those the percent with the suffix first.
REARRANGED, SUFFIX_FIRST = 90, 20
#: Words of a bitmap container: 65,536 bits.
_BITMAP_WORDS = 1024


class ArrayContainer:
    def __init__(self, low: np.ndarray):
        self.low = low

    def select(self, k: int) -> int:
        return int(self.low[k])


class BitmapContainer:
    def __init__(self, low: np.ndarray):
        bits = np.zeros(64 * _BITMAP_WORDS, np.uint8)
        bits[low] = 1
        self.words = np.packbits(bits, bitorder="little").view(np.uint64)
        self.until = np.cumsum(np.bitwise_count(self.words), dtype=np.int64)

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.until, k, side="right"))
        before = int(self.until[word - 1]) if word else 0
        bits = np.unpackbits(self.words[word : word + 1].view(np.uint8), bitorder="little")
        return 64 * word + int(np.flatnonzero(bits)[k - before])


class RunContainer:
    def __init__(self, low: np.ndarray, starts: np.ndarray):
        self.first = low[starts]
        self.until = np.append(starts[1:], len(low)).astype(np.int64)

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.until, k, side="right"))
        before = int(self.until[run - 1]) if run else 0
        return int(self.first[run]) + k - before


def container(low: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest container of rising 16-bit values: 2 bytes a value, 8 KB, or 4 bytes a run."""
    starts = np.flatnonzero(np.diff(low.astype(np.int32), prepend=-2) != 1)
    array, bitmap, runs = 2 * len(low), 8 * _BITMAP_WORDS, 4 * len(starts)
    if array <= min(bitmap, runs):
        return ArrayContainer(low)
    return RunContainer(low, starts) if runs <= bitmap else BitmapContainer(low)


class OffsetSet:
    """Rising offsets in containers of 65,536 each."""

    def __init__(self, offsets: np.ndarray):
        high = offsets >> 16
        cuts = np.append(np.flatnonzero(np.diff(high, prepend=-1)), len(offsets))
        self.high = high[cuts[:-1]]
        self.containers = [container((offsets[a:b] & 0xFFFF).astype(np.uint16)) for a, b in zip(cuts, cuts[1:])]
        self.until = cuts[1:]

    def __len__(self) -> int:
        return int(self.until[-1]) if len(self.until) else 0

    def select(self, k: int) -> int:
        """The k-th smallest offset, from 0."""
        at = int(np.searchsorted(self.until, k, side="right"))
        before = int(self.until[at - 1]) if at else 0
        return (int(self.high[at]) << 16) + self.containers[at].select(k - before)


def boundaries(text: str) -> OffsetSet:
    """Offsets at which a unit begins or the text ends: a unit is a run of A-Z and a-z, or one other character."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    letter = (codes | np.uint32(0x20)) - np.uint32(97) < 26
    begins = np.ones(len(codes) + 1, bool)
    begins[1:-1] = ~(letter[1:] & letter[:-1])
    return OffsetSet(np.flatnonzero(begins))


def draws(doc_id: str | None, seed: str) -> list[int]:
    """Four numbers drawn for a document; a NULL id draws as an empty one."""
    found = hashlib.sha256(f"{seed}:{doc_id or ''}".encode()).hexdigest()
    return [int(found[i : i + 8], 16) for i in range(0, 32, 8)]


def arranged(doc_id: str | None, text: str | None, seed: str) -> tuple:
    """``n, form, prefix_chars, middle_chars, output`` of one text."""
    text = text or ""
    marks = boundaries(text)
    n = len(marks) - 1
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= REARRANGED:
        return n, "plain", None, None, text
    a, b = (marks.select(k) for k in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < SUFFIX_FIRST:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


_OUT = ("n", "form", "prefix_chars", "middle_chars", "output")
_KINDS = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.large_string())


def fill_middle(docs: DataFrame, seed: str = "1") -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of each whole text.

    ``n`` counts units, ``form`` is psm, spm or plain, ``output`` is the rearranged text. The
    cuts come from a hash of ``seed`` and id, so that a run repeats. One row per input row,
    repeated rows and NULL ids included (a NULL id is cut like an empty one); a NULL text counts
    as empty, an empty one is plain with n = 0; a text that holds a mark is plain. An empty
    table gives no rows; other columns are ignored. A text has to fit in a task's memory.
    """

    def arrange(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shown, texts = batch.column(1), batch.column(2)
            found = [arranged(i.as_py(), t.as_py(), seed) for i, t in zip(shown, texts)]
            columns = list(zip(*found)) or [()] * len(_OUT)
            arrays = [batch.column(0), *(pa.array(c, kind) for c, kind in zip(columns, _KINDS))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", *_OUT])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("doc_id").cast("string").alias("shown"), "text")
    return rows.mapInArrow(arrange, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of. Each mark occurs once in a rearranged text."""

    def after(text: Column, mark: str) -> Column:
        return F.split_part(text, F.lit(mark), F.lit(2))

    def before(text: Column, mark: str) -> Column:
        return F.split_part(text, F.lit(mark), F.lit(1))

    psm = F.concat(before(after(output, PREFIX), SUFFIX), after(output, MIDDLE), before(after(output, SUFFIX), MIDDLE))
    spm = F.concat(before(after(output, PREFIX), MIDDLE), after(output, MIDDLE), before(after(output, SUFFIX), PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def report(docs: DataFrame, seed: str = "1") -> DataFrame:
    """``fill_middle`` with digests of the output and of the text restored from it."""
    made = fill_middle(docs, seed)
    back = restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(back, 256).alias("restored_sha256"),
    )


ORACLE = """
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), drawn AS (
  SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS units,
    CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
    CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM texts
), cuts AS (
  SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
    greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), parts AS (
  SELECT doc_id, text, n, form, array_to_string(units[1:a], '') AS p, array_to_string(units[a + 1:b], '') AS m,
    array_to_string(units[b + 1:n], '') AS s
  FROM cuts
), made AS (
  SELECT *, CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END AS output
  FROM parts
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars, sha256(output) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN output ELSE p || m || s END) AS restored_sha256
FROM made
"""
