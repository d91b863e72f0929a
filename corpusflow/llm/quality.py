"""A quality classifier from overlapping heuristics.

Heuristic labellers with overlapping faults vote on every document. Expectation-maximisation over the
counts of vote patterns estimates how accurate each one is; the posterior of a pattern labels
its documents, and these labels train a linear scorer on hashed features.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusflow.llm.blocks import arrow_type, blocks
from corpusflow.llm.line_rules import SYMBOLS, repeated_words
from corpusflow.llm.sampling import sample

LABELLERS = ("symbols", "plain", "capitals", "ends", "windows", "variety", "again", "lines", "pauses")
#: Rows that train the scorer, chosen by the hash of their ids.
TRAIN_ROWS = 8000
BUCKETS = 1 << 18
ROUNDS, STEPS, RATE = 50, 60, 0.5
#: Stands for a word that repeats the one before it.
AGAIN = b"\x00again"


def words_of(text: str) -> list[bytes]:
    """The words, and a mark for each that repeats the word before."""
    words = text.encode().split()
    again = sum(map(bytes.__eq__, words, words[1:]))
    return words + [AGAIN] * again


def votes(text: str | None) -> str:
    """One letter per labeller: ``b`` where it sees its fault, else ``g``."""
    text = text or ""
    words = text.split()
    n = len(words)
    if n == 0:
        return "b" * len(LABELLERS)
    lines = [line for line in text.split("\n") if line.strip()]
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    upper = np.count_nonzero((codes - 65 < 26) | ((codes - 0xC0 < 31) & (codes != 0xD7)))
    letters = upper + np.count_nonzero((codes - 97 < 26) | (codes > 0xDE))
    bare = [w.rstrip(".,;:?") for w in words]
    faults = (
        sum(map(text.count, SYMBOLS + "!")) > 0.02 * len(text),
        sum(map(str.isalpha, bare)) < 0.7 * n,
        upper > 0.4 * letters,  # A-Z and the capitals of Latin-1
        sum(w[-1] in "!*#$%&" for w in words) > 0.2 * n,
        repeated_words(text.encode().split()) > 0.3 * n,
        n >= 10 and len(set(words)) < 0.2 * min(n, 500),
        sum(a == b for a, b in zip(bare, bare[1:])) > 0.2 * n,
        len(set(lines)) < 0.6 * len(lines),
        sum(w[-1] in ".,;:?" for w in words) > 0.6 * n,
    )
    return "".join("b" if fault else "g" for fault in faults)


def accuracies(patterns: list[str], counts: np.ndarray) -> tuple[np.ndarray, dict[str, float]]:
    """How often each labeller sees its fault in good and in bad documents, and the posterior
    of a good document for each pattern of votes."""
    saw = np.array([[v == "b" for v in p] for p in patterns], float)
    share, rates = 0.85, np.stack([np.full(saw.shape[1], 0.01), np.full(saw.shape[1], 0.4)])
    posterior = np.zeros(len(patterns))
    for _ in range(ROUNDS):
        good, bad = (saw @ np.log(r) + (1 - saw) @ np.log(1 - r) for r in rates)
        odds = bad + np.log(1 - share) - good - np.log(share)
        posterior = 1 / (1 + np.exp(np.clip(odds, -50, 50)))
        share = float(np.clip(posterior @ counts / counts.sum(), 0.05, 0.95))
        for k, weight in enumerate((posterior * counts, (1 - posterior) * counts)):
            rates[k] = np.clip((weight @ saw + 0.1) / (weight.sum() + 1), 0.001, 0.99)
    return rates, dict(zip(patterns, posterior.tolist()))


def features(words: list[bytes]) -> np.ndarray:
    """Two buckets per distinct word: the word and its shape."""
    out = np.empty((len(words), 2), np.int64)
    for k, word in enumerate(words):
        text = word.decode()
        kinds = ["A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in text]
        shape = "".join(c for c, before in zip(kinds, [""] + kinds) if c != before)
        out[k] = zlib.crc32(text.lower().encode()) % BUCKETS, zlib.crc32(b"\x01" + shape.encode()) % BUCKETS
    return out


def _matrix(block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents, buckets and values of a block; each document has length one."""
    width = np.int64(max(1, len(block.words)))
    keys, times = np.unique(block.documents() * width + block.run, return_counts=True)
    doc, buckets = keys // width, features(block.words)
    doc = np.concatenate([doc, doc])
    bucket = buckets[keys % width].T.ravel()
    merged, at = np.unique(doc * BUCKETS + bucket, return_inverse=True)
    value = np.sqrt(np.bincount(at, weights=np.concatenate([times, times])))
    doc, bucket = merged // BUCKETS, merged % BUCKETS
    length = np.sqrt(np.bincount(doc, weights=value**2, minlength=len(block.ends)))
    return doc, bucket, value / length[doc]


def _fit(doc: np.ndarray, bucket: np.ndarray, value: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Weights of the buckets and, last, the offset; full steps with a rate per weight."""
    weights, squares = np.zeros(BUCKETS + 1), np.full(BUCKETS + 1, 1e-8)
    for _ in range(STEPS):
        z = np.bincount(doc, weights=weights[bucket] * value, minlength=len(label)) + weights[-1]
        error = (1 / (1 + np.exp(-z)) - label) / len(label)
        step = np.bincount(bucket, weights=error[doc] * value, minlength=BUCKETS + 1)
        step[-1] = error.sum()
        squares += step**2
        weights -= RATE * step / np.sqrt(squares)
    return weights


def classify(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id, score, kept`` of each whole text.

    ``score`` is the scorer's probability of a good document. The labellers vote on all
    documents; at most ``train_rows`` rows, with the posteriors of their votes, train the scorer.
    Rows of one id are chosen together or not at all: with nothing chosen the scorer learns
    nothing and gives 0.5.

    One row per input row, repeated rows and NULL ids included; a NULL or blank text
    has every vote against it, gets score 0 and isn't kept. An empty table gives no rows; other
    columns are ignored.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    id_type = arrow_type(docs)
    texts = docs.select("doc_id", "text")

    def voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([votes(t.as_py()) for t in batch.column(0)], pa.string())
            yield pa.RecordBatch.from_arrays([found], names=["votes"])

    counted = texts.select("text").mapInArrow(voted, "votes string").groupBy("votes").count().collect()
    if not counted:
        return spark.createDataFrame([], f"doc_id {kind}, score double, kept boolean")
    patterns, counts = [r["votes"] for r in counted], np.array([r["count"] for r in counted], float)
    _, posterior = accuracies(patterns, counts)

    chosen = sample(texts, train_rows)

    def trained(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frames = list(frames)
        if not frames:
            return
        rows = pd.concat(frames)
        label = np.array([posterior[votes(t)] for t in rows["text"]])
        batch = pa.RecordBatch.from_pandas(rows[["doc_id", "text"]].astype({"text": object}), preserve_index=False)
        (block,) = blocks([batch], words_of, size=1 << 60)
        weights = _fit(*_matrix(block), label)
        used = np.flatnonzero(weights)
        yield pd.DataFrame({"bucket": used, "weight": weights[used]})

    model = chosen.coalesce(1).mapInPandas(trained, "bucket long, weight double").toPandas()
    weights = np.zeros(BUCKETS + 1)
    weights[model["bucket"]] = model["weight"]
    shared = spark.sparkContext.broadcast(weights)  # BUCKETS numbers

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, words_of, size=8_000_000):
            doc, bucket, value = _matrix(block)
            z = np.bincount(doc, weights=shared.value[bucket] * value, minlength=len(block.ends)) + shared.value[-1]
            score = np.where(np.diff(block.ends, prepend=0) > 0, 1 / (1 + np.exp(-z)), 0.0)
            arrays = [pa.array([d for d, in block.rows], id_type), pa.array(score), pa.array(score >= 0.5)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "score", "kept"])

    return texts.mapInArrow(scored, f"doc_id {kind}, score double, kept boolean")
