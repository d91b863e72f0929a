"""Interpolated modified Kneser-Ney model of word pairs, counted and applied by shards.

Pairs of words are counted in the shard of their hash. A shard is a sorted array of hashes
with counts, stored in the shared folder and memory-mapped by the worker that answers the
blocks. The first block with a counted pair adds it to the contexts and continuations of its
words; these are summed by shards of words, stored and mapped in the same way.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from corpusflow.llm.blocks import (
    ANSWER, MESSAGE, OWN, blocks, hashes, messages, narrow, pack, pack_object, rising, settled, shard_count,
    shard_of, unpack, unpack_object,
)
from corpusflow.session import fresh_path, stored

#: The end of a text, also the context of its first word. No word holds a line feed.
END = b"\n"
WORDS, TOTALS = 2, 3
#: Bits of a pair's hash within its shard; with bounded shards the rate of collisions is the same at any size.
_KEY_BITS = 40
_LOW = np.uint64((1 << _KEY_BITS) - 1)
#: Discounts where a count of counts is zero.
FALLBACK = (0.5, 1.0, 1.5)


@dataclass
class Model:
    """Where the sorted arrays are, and the totals that every score needs."""

    path: str
    shards: int
    pair_counts: list[int] = field(default_factory=list)
    word_counts: list[int] = field(default_factory=list)

    def discounts(self) -> np.ndarray:
        return discounts(self.pair_counts[:4])

    def continuation_discounts(self) -> np.ndarray:
        return discounts(self.word_counts[3:7])


def discounts(counts: list[int]) -> np.ndarray:
    """Discounts of terms counted not at all, once, twice and more often."""
    n1, n2, n3, n4 = counts
    if not (n1 and n2 and n3 and n4):
        return np.array((0.0, *FALLBACK))
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return np.array((0.0, *(min(max(d, 0.0), float(k + 1)) for k, d in enumerate(found))))


def tokens(text: str) -> list[bytes]:
    """Words between ASCII white space, with A-Z in lower case, and the end."""
    return [*text.encode().lower().split(), END]


def _folder(path: str) -> str:
    """A path that workers can map. Other stores hold no files to map."""
    scheme, _, rest = path.rpartition("://")
    if not scheme:
        return path.removeprefix("file:")
    if scheme != "file":
        raise ValueError(f"the model needs a mounted shared folder, not {path}")
    return rest


def _save(folder: str, name: str, values: np.ndarray) -> None:
    """Whole or not at all, also if a task runs twice."""
    os.makedirs(folder, exist_ok=True)
    part = f"{folder}/.{name}-{uuid.uuid4().hex}"
    with open(part, "wb") as out:
        np.save(out, values)
    os.replace(part, f"{folder}/{name}.npy")


def _mapped(folder: str, name: str) -> np.ndarray:
    return np.load(f"{folder}/{name}.npy", mmap_mode="r")


def _save_pairs(folder: str, shard: int, keys: np.ndarray, counts: np.ndarray) -> None:
    """Sorted keys as 256 stretches of 32-bit remainders."""
    starts = np.searchsorted(keys, np.arange(257, dtype=np.uint64) << np.uint64(32))
    _save(folder, f"pairs-{shard}-starts", starts.astype(np.uint32))
    _save(folder, f"pairs-{shard}-rest", keys.astype(np.uint32))
    _save(folder, f"pairs-{shard}-count", narrow(counts))


def _find(known: np.ndarray, keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Values of the keys, zero for unknown ones."""
    if not len(known):
        return np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, values[at], 0).astype(np.int64)


def _find_pairs(folder: str, shard: int, keys: np.ndarray) -> np.ndarray:
    starts = _mapped(folder, f"pairs-{shard}-starts")
    stretch = np.repeat(np.arange(256, dtype=np.uint64) << np.uint64(32), np.diff(starts.astype(np.int64)))
    known = stretch | _mapped(folder, f"pairs-{shard}-rest")
    return _find(known, keys, _mapped(folder, f"pairs-{shard}-count"))


class _Pairs:
    """Distinct pairs of a block, sorted by shard and key."""

    def __init__(self, run: np.ndarray, word_hashes: np.ndarray, shards: int):
        before = np.concatenate([np.zeros(1, run.dtype), run[:-1]])  # the end has number 0
        h = word_hashes[before] * np.uint64(0x9E3779B97F4A7C15) + word_hashes[run]
        for factor in (0xD6E8FEB86659FD93, 0xCA5A826395121157):
            h = (h ^ (h >> np.uint64(32))) * np.uint64(factor)
        h ^= h >> np.uint64(32)
        keys = shard_of(h, shards).astype(np.uint64) << np.uint64(_KEY_BITS) | (h & _LOW)
        self.keys, first, self.inverse = np.unique(keys, return_index=True, return_inverse=True)
        self.before, self.word = before[first], run[first]
        bounds = np.arange(shards + 1, dtype=np.uint64) << np.uint64(_KEY_BITS)
        self.cuts = np.searchsorted(self.keys, bounds)


def _pair_counts(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """Distinct pairs of each block and how often the learned documents have them."""
    for block in blocks(batches, tokens, first=(END,)):
        pairs = _Pairs(block.run, hashes(block.words), shards)
        learned = np.array([learn for _, learn in block.rows])[block.documents()]
        counts = np.bincount(pairs.inverse, weights=learned, minlength=len(pairs.keys)).astype(np.int64)
        for s in np.flatnonzero(np.diff(pairs.cuts)).tolist():
            cut = slice(pairs.cuts[s], pairs.cuts[s + 1])
            data = pack(narrow(rising(pairs.keys[cut] & _LOW)), narrow(counts[cut]))
            yield messages([(s, OWN, block.name, data)])


def _totals(shard: int, counts: list[int]) -> pd.DataFrame:
    data = ",".join(str(int(n)) for n in counts).encode()
    return pd.DataFrame({"to": [-1], "kind": [TOTALS], "part": [shard], "data": [data]})


def _counts_of_counts(values: np.ndarray) -> list[int]:
    return np.bincount(np.minimum(values, 5), minlength=6)[1:5].tolist()


def _answer_pairs(key: tuple, sent: pd.DataFrame, folder: str, build: bool) -> pd.DataFrame:
    """Store a shard's counts, then answer each block from the mapped arrays."""
    shard, sent = int(key[0]), sent.sort_values("part")
    parts = [unpack(d) for d in sent["data"]]
    lists = [np.cumsum(steps, dtype=np.uint64) for steps, _ in parts]
    keys = np.concatenate(lists)
    counts = np.concatenate([c.astype(np.int64) for _, c in parts])
    owned = np.zeros(len(keys), np.int64)
    totals = np.empty(0, np.int64)
    if build:
        known, at = np.unique(keys, return_inverse=True)
        totals = np.bincount(at, weights=counts, minlength=len(known)).astype(np.int64)
        learned = np.flatnonzero(counts)[::-1]
        first = np.full(len(known), -1)
        first[at[learned]] = learned  # the last to be set is the first in order
        owned[first[first >= 0]] = 1
        _save_pairs(folder, shard, known[totals > 0], totals[totals > 0])
    ends = np.cumsum([len(k) for k in lists])
    answers = [
        pack(narrow(_find_pairs(folder, shard, k) * 2 + owned[end - len(k) : end])) for k, end in zip(lists, ends)
    ]
    out = pd.DataFrame({"to": sent["part"], "kind": ANSWER, "part": shard, "data": answers})
    return pd.concat([out, _totals(shard, _counts_of_counts(totals))]) if build else out


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block keeps its documents as numbers of words, and the words' hashes."""
    for block in blocks(batches, tokens, first=(END,)):
        data = pack(block.run, block.ends, hashes(block.words), pack_object(block.rows))
        yield messages([(block.name, OWN, 0, data)])


def _own(sent: pd.DataFrame, shards: int) -> tuple:
    """The block's documents, its pairs, their counts and which of them it adds to the words."""
    own = sent[sent["kind"] == OWN]
    if len(own) != 1:
        raise RuntimeError("answers for a block that the second scan did not make")
    run, ends, word_hashes, rows = unpack(own["data"].iloc[0])
    pairs = _Pairs(run, word_hashes, shards)
    told = sent[sent["kind"] == ANSWER].sort_values("part")
    found = np.concatenate([unpack(d)[0].astype(np.int64) for d in told["data"]])
    if len(found) != len(pairs.keys):
        raise RuntimeError("answers for a block that the second scan did not make")
    return run, ends, word_hashes, unpack_object(rows), pairs, found >> 1, (found & 1).astype(bool)


def _word_stats(key: tuple, sent: pd.DataFrame, shards: int) -> pd.DataFrame:
    """What a block adds to its words: count, followers seen once, twice, more often, predecessors."""
    run, ends, word_hashes, rows, pairs, counts, owned = _own(sent, shards)
    n = len(word_hashes)
    learned = np.repeat([learn for _, learn in rows], np.diff(ends, prepend=0))
    stats = [np.bincount(run[learned], minlength=n)]
    stats += [np.bincount(pairs.before[owned & (np.minimum(counts, 3) == k)], minlength=n) for k in (1, 2, 3)]
    stats += [np.bincount(pairs.word[owned], minlength=n)]
    order = np.argsort(word_hashes)
    shard = shard_of(word_hashes[order], shards)
    out = []
    for s in np.unique(shard).tolist():
        at = order[shard == s]
        out.append((s, OWN, int(key[0]), pack(rising(word_hashes[at]), *(narrow(x[at]) for x in stats))))
    return pd.DataFrame(out, columns=["to", "kind", "part", "data"])


def _answer_words(key: tuple, sent: pd.DataFrame, folder: str, build: bool) -> pd.DataFrame:
    shard = int(key[0])
    parts = [unpack(d) for d in sent["data"]]
    lists = [np.cumsum(p[0], dtype=np.uint64) for p in parts]
    known, sums = np.empty(0, np.uint64), [np.empty(0, np.int64)] * 5
    if build:
        known, at = np.unique(np.concatenate(lists), return_inverse=True)
        sums = [
            np.bincount(at, weights=np.concatenate([p[k] for p in parts]), minlength=len(known)).astype(np.int64)
            for k in range(1, 6)
        ]
        learned = sums[0] > 0
        known, sums = known[learned], [x[learned] for x in sums]
        _save(folder, f"words-{shard}-hash", known)
        for k, x in enumerate(sums):
            _save(folder, f"words-{shard}-{k}", narrow(x))
    known, *stats = (_mapped(folder, f"words-{shard}-{name}") for name in ("hash", 0, 1, 2, 3, 4))
    answers = [pack(*(narrow(_find(known, k, x)) for x in stats)) for k in lists]
    out = pd.DataFrame({"to": sent["part"], "kind": WORDS, "part": shard, "data": answers})
    if not build:
        return out
    totals = [sums[0].sum(), len(known), sums[4].sum(), *_counts_of_counts(sums[4])]
    return pd.concat([out, _totals(shard, totals)])


def _log10(values: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.log10(values)


def _scores(sent: pd.DataFrame, model: Model) -> pd.DataFrame:
    run, ends, word_hashes, rows, pairs, counts, _ = _own(sent, model.shards)
    order = np.argsort(word_hashes)
    told = sent[sent["kind"] == WORDS].sort_values("part")
    stats = np.zeros((5, len(word_hashes)))
    stats[:, order] = np.concatenate([np.stack([x.astype(float) for x in unpack(d)]) for d in told["data"]], axis=1)
    count, followers, before = stats[0], stats[1:4], stats[4]
    n, v, pairs_seen = model.word_counts[:3]

    low = model.continuation_discounts()
    ones, twos = model.word_counts[3:5]
    more = v - ones - twos
    if pairs_seen:
        left = (low[1] * ones + low[2] * twos + low[3] * more) / pairs_seen
        lower = (before - low[np.minimum(before, 3).astype(int)]) / pairs_seen + left / (v + 1)
    else:
        lower = np.full(len(count), 1 / (v + 1))
    high = model.discounts()
    context = count[pairs.before]
    seen = np.maximum(context, 1)
    left = (high[1:, None] * followers[:, pairs.before]).sum(axis=0) / seen
    upper = (counts - high[np.minimum(counts, 3)]) / seen + left * lower[pairs.word]
    score = _log10(np.where(context > 0, upper, lower[pairs.word]))[pairs.inverse]
    base = _log10((count + 1) / (n + v + 1))[run]

    starts = np.concatenate([[0], ends[:-1]])
    ids, held_out = [r[0] for r in rows], [not r[1] for r in rows]
    out = pd.DataFrame({"doc_id": pd.Series(ids, dtype=object), "held_out": held_out, "n_tokens": ends - starts})
    out["n_known"] = np.add.reduceat((count > 0).astype(np.int64)[run], starts)
    out["train_tokens"] = n
    out["base_score"] = np.add.reduceat(base, starts)
    out["score"] = np.add.reduceat(score, starts)
    out["perplexity"] = 10 ** (-out["score"] / out["n_tokens"])
    return out


def _sums(table: DataFrame, shards_of: int) -> list[int]:
    numbers = F.posexplode(F.split(F.decode("data", "UTF-8"), ",")).alias("at", "n")
    found = table.filter(f"kind = {TOTALS}").select(numbers).groupBy("at").agg(F.sum(F.col("n").cast("long")).alias("n"))
    return [row["n"] for row in sorted(found.collect())] or [0] * shards_of


def _run(rows: DataFrame, model: Model, build: bool) -> DataFrame:
    folder, shards = _folder(model.path), model.shards
    own = rows.mapInArrow(_documents, MESSAGE)
    pairs = (
        rows.mapInArrow(partial(_pair_counts, shards=shards), MESSAGE)
        .groupBy("to")
        .applyInPandas(lambda key, sent: _answer_pairs(key, sent, folder, build), MESSAGE)
    )
    pairs = stored(pairs, "pairs")
    answers = pairs.filter(f"kind = {ANSWER}")
    words = (
        own.unionByName(answers)
        .groupBy("to")
        .applyInPandas(lambda key, sent: _word_stats(key, sent, shards), MESSAGE)
        .groupBy("to")
        .applyInPandas(lambda key, sent: _answer_words(key, sent, folder, build), MESSAGE)
    )
    words = stored(words, "words")
    if build:
        model.pair_counts, model.word_counts = _sums(pairs, 4), _sums(words, 7)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
        "score double, perplexity double"
    )
    told = own.unionByName(answers).unionByName(words.filter(f"kind = {WORDS}"))
    return told.groupBy("to").applyInPandas(lambda sent: _scores(sent, model), schema)


def train_and_score(docs: DataFrame, learn: Column, stable: bool = False) -> tuple[Model, DataFrame]:
    """Learn from the documents where ``learn`` is true, score all of them.

    The scores: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    perplexity``, logarithms to base 10. ``base_score`` adds one to the count of each single
    word; ``score`` is the model's. Tokens are the words and one end of text.

    One row per input row, repeated rows (which count again) and NULL ids included. A NULL or
    empty text is its end alone. Where ``learn`` is NULL a document isn't learned from. With
    nothing to learn from, every word is equally likely; an empty table gives no rows. Other
    columns of ``docs`` are ignored. ``docs`` are written to the shared folder first, unless they
    are ``stable`` (see ``blocks.settled``).
    """
    rows = settled(docs.select("doc_id", F.coalesce(learn, F.lit(False)).alias("learn"), "text"), stable)
    model = Model(fresh_path(docs.sparkSession, "ngrams"), shard_count(rows))
    return model, _run(rows, model, build=True)


def score(docs: DataFrame, model: Model, stable: bool = False) -> DataFrame:
    """Scores of further documents by a stored model; the columns of ``train_and_score``."""
    rows = settled(docs.select("doc_id", F.lit(False).alias("learn"), "text"), stable)
    return _run(rows, model, build=False)
