"""I-Match fingerprints over randomised subsets of a lexicon.

The lexicon holds the terms whose document frequency lies in a band. A document's distinct
lexicon terms, sorted, are hashed once for each of several random subsets of the lexicon; a
fingerprint is the run of these hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from corpusflow.llm.blocks import (
    MESSAGE, OWN, arrow_type, blocks, hashes, messages, narrow, pack, rising, shard_count, shard_of, unpack,
)
from corpusflow.session import stored

#: The band as shares of all documents. The lower end bounds the lexicon, whatever the number of
#: documents: at most the mean number of distinct terms of a document, divided by it.
RARE, COMMON = 0.0005, 0.1
LEAST_DOCUMENTS = 2
#: Random parts that the lexicon is cut into, and hexadecimal digits of the hash of each.
SUBSETS = 64
_HEX = 4
_HEXADECIMAL = ("edited_sha256", "fingerprint", "edited_fingerprint")


def terms(text: str) -> list[bytes]:
    return text.encode().lower().split()


def _frequencies(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """Each block's distinct terms by hash, with the number of its documents that have them."""
    for block in blocks(batches, terms):
        width = np.int64(max(1, len(block.words)))
        keys = np.unique(block.documents() * width + block.run)
        found = hashes(block.words)
        counts = np.bincount(keys % width, minlength=len(found))
        order = np.argsort(found)
        found, counts = found[order], counts[order]
        shard = shard_of(found, shards)
        for s in np.unique(shard).tolist():
            data = pack(narrow(rising(found[shard == s])), narrow(counts[shard == s]))
            yield messages([(s, OWN, block.name, data)])


def _band(sent: pd.DataFrame, least: float, most: float) -> pd.DataFrame:
    parts = [unpack(d) for d in sent["data"]]
    keys = np.concatenate([np.cumsum(steps, dtype=np.uint64) for steps, _ in parts])
    known, at = np.unique(keys, return_inverse=True)
    counts = np.bincount(at, weights=np.concatenate([c for _, c in parts]), minlength=len(known))
    return pd.DataFrame({"term": known[(counts >= least) & (counts <= most)].view(np.int64)})


def lexicon(docs: DataFrame) -> np.ndarray:
    """Sorted hashes of the terms in the band, counted over all documents."""
    texts = docs.select("text")
    n = texts.count()
    least, most = max(LEAST_DOCUMENTS, RARE * n), max(LEAST_DOCUMENTS, COMMON * n)
    found = (
        texts.mapInArrow(partial(_frequencies, shards=shard_count(texts)), MESSAGE)
        .groupBy("to")
        .applyInPandas(lambda sent: _band(sent, least, most), "term long")
        .toPandas()
    )
    return np.sort(found["term"].to_numpy(np.int64).view(np.uint64))


class Fingerprints:
    """Fingerprints by a lexicon; built once in each task."""

    def __init__(self, known: np.ndarray):
        self.known = known
        self.cache: dict[bytes, int] = {}

    def _hash(self, word: bytes) -> int:
        if len(self.cache) > 500_000:
            self.cache.clear()
        found = self.cache[word] = xxhash.xxh64_intdigest(word)
        return found

    def __call__(self, text: str) -> str:
        cache = self.cache
        own = {cache[w] if w in cache else self._hash(w) for w in set(terms(text))}
        own = np.sort(np.fromiter(own, np.uint64, len(own)))
        if len(self.known):
            at = np.minimum(np.searchsorted(self.known, own), len(self.known) - 1)
            inside = own[self.known[at] == own]
            own = inside if len(inside) else own  # without lexicon terms, all terms count
        subset = (own * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(SUBSETS)
        own = own[np.argsort(subset, kind="stable")]
        ends = np.cumsum(np.bincount(subset.astype(np.int64), minlength=SUBSETS)).tolist()
        digest, data = xxhash.xxh32_hexdigest, own.tobytes()
        return "".join(
            digest(data[8 * a : 8 * b])[:_HEX] if b > a else "0" * _HEX for a, b in zip([0, *ends[:-1]], ends)
        )


def likeness(a: str, b: str) -> float:
    """Share of equal hashes among the subsets that either text has terms in."""
    pairs = [(a[k : k + _HEX], b[k : k + _HEX]) for k in range(0, len(a), _HEX)]
    used = [x == y for x, y in pairs if x != "0" * _HEX or y != "0" * _HEX]
    return sum(used) / len(used) if used else float(a == b)


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by as much of the beginning of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _row(make: Fingerprints, doc_id, text: str, own: str, after: str, after_own: str | None = None) -> tuple:
    changed = edited(text, after)
    changed_own = make(changed)
    after_own = make(after) if after_own is None else after_own
    digest = hashlib.sha256(changed.encode()).hexdigest()
    return doc_id, len(text), digest, own, changed_own, likeness(own, changed_own), likeness(own, after_own)


_COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _neighbours(batches: Iterator[pa.RecordBatch], known, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Results of sorted rows from each row and the next; the ends of the range with their texts."""
    make, before, first, number = Fingerprints(known.value), None, None, 0

    def batch_of(rows: list[tuple], ends: list[tuple] = ()) -> pa.RecordBatch:
        whole = [(*r, None, None, None) for r in rows] + [(d, *[None] * 6, r, e, t) for r, e, d, t in ends]
        types = [kind, pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64(), pa.int64(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(zip(*whole), types)], names=[*_COLUMNS, "range", "end", "text"]
        )

    for batch in batches:
        out = []
        for doc_id, text, task in zip(*(batch.column(i).to_pylist() for i in range(3))):
            own = make(text)
            if before:
                out.append(_row(make, *before, text, own))
            first = first or (task, "first", doc_id, text)
            before, number = (doc_id, text, own), task
        if out:
            yield batch_of(out)
    if before:
        yield batch_of([], [first, (number, "last", *before[:2])])


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each whole text, of its edited text, and their likeness.

    The edited text ends with the beginning of the next document in descending order of id,
    the first one after the last; NULL ids come last, equal ids in the order of their texts.
    Texts are shuffled once, by ranges of ids. The ends of the ranges meet in a small join.

    One row per input row, repeated rows included; a NULL text counts as empty, and two
    texts without terms are alike. A single row is its own neighbour. An empty table gives no
    rows; other columns are ignored.
    """
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast(lexicon(docs))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), "text"]
    ranges = texts.repartitionByRange(shard_count(texts), *order[:2]).sortWithinPartitions(*order)
    kind = arrow_type(docs)
    name = docs.schema["doc_id"].dataType.simpleString()
    result = (
        f"doc_id {name}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    whole = ranges.withColumn("range", F.spark_partition_id().cast("long")).mapInArrow(
        lambda batches: _neighbours(batches, known, kind), f"{result}, range long, end string, text string"
    )
    whole = stored(whole.withColumns({c: F.unhex(c) for c in _HEXADECIMAL}), "fingerprints")  # half the bytes
    whole = whole.withColumns({c: F.lower(F.hex(c)) for c in _HEXADECIMAL})
    done = whole.filter("end IS NULL").select(_COLUMNS)

    ends = whole.filter("end IS NOT NULL").select("range", "end", "doc_id", "text")
    firsts, lasts = (ends.filter(F.col("end") == e) for e in ("first", "last"))
    numbers = firsts.select("range")
    following = numbers.select(
        "range",
        F.coalesce(F.lead("range").over(Window.orderBy("range")), F.min("range").over(Window.partitionBy())).alias("to"),
    )
    met = (
        lasts.select("range", "doc_id", "text")
        .join(following, "range")
        .join(firsts.select(F.col("range").alias("to"), F.col("text").alias("after")), "to")
        .select("doc_id", "text", "after")
    )

    def over_ends(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        make = Fingerprints(known.value)
        for rows in frames:
            out = [_row(make, d, t, make(t), a) for d, t, a in rows.itertuples(index=False)]
            yield pd.DataFrame(out, columns=_COLUMNS)

    return done.unionByName(met.mapInPandas(over_ends, result))
