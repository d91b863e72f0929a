"""Token counts without token ids.

Pieces are counted once per distinct pre-token of the corpus, joined to the pre-token
frequencies of each document, and summed.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pandas as pd
import pyarrow as pa
import re
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from corpusflow.llm.blocks import (
    ANSWER, MESSAGE, OWN, blocks, hashes, messages, narrow, pack, pack_object, pack_words, rising, settled,
    shard_count, shard_of, unpack, unpack_object, unpack_words,
)

_AFTER_SPACE = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S)(?= )")
#: Marks a unit that is written out; any other unit stands for itself after one space.
LITERAL = "\ue000"


def units(text: str) -> list[str]:
    """The text cut before every space that follows a character other than white space.

    No pre-token of a pattern that lets only white space, or one leading space, stand inside a
    piece crosses such a cut, and none looks back over it: the tokens of a text are those of
    its units. Normalisation does not join characters over a space either.
    """
    if LITERAL in text or _AFTER_SPACE.search(text):
        return [LITERAL + unit for unit in _CUT.split(text)]
    head, *rest = text.split(" ")
    return [LITERAL + head, *rest]


def spelled(unit: str) -> str:
    return unit[1:] if unit.startswith(LITERAL) else " " + unit


@cache
def tokenizer(path: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    return model


def distinct_units(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """The distinct units of each block, sent to their shards."""
    for block in blocks(batches, units):
        words = [w.encode() for w in block.words]
        shard = shard_of(hashes(words), shards)
        for s in np.unique(shard).tolist():
            yield messages([(s, OWN, block.name, pack_words([words[i] for i in np.flatnonzero(shard == s)]))])


def encoded_once(lists: list[list[bytes]], path: str, rows: int = 20_000) -> Iterator[tuple[bytes, list[int]]]:
    """Every distinct unit of a shard with its token ids."""
    known = list(dict.fromkeys(w for words in lists for w in words))
    model = tokenizer(path)
    for at in range(0, len(known), rows):
        part = known[at : at + rows]
        found = model.encode_batch_fast([spelled(w.decode()) for w in part], add_special_tokens=False)
        yield from zip(part, (e.ids for e in found))


def _piece_counts(key: tuple, sent: pd.DataFrame, path: str) -> pd.DataFrame:
    lists = [unpack_words(d) for d in sent["data"]]
    pieces = {w: len(ids) for w, ids in encoded_once(lists, path)}
    answers = [pack(narrow(np.fromiter(map(pieces.__getitem__, words), np.int64, len(words)))) for words in lists]
    return pd.DataFrame({"to": sent["part"], "kind": ANSWER, "part": key[0], "data": answers})


def _frequencies(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """Each block keeps, per document, the units and how often they occur."""
    for block in blocks(batches, units):
        width = np.int64(max(1, len(block.words)))
        keys, times = np.unique(block.documents() * width + block.run, return_counts=True)
        shard = shard_of(hashes([w.encode() for w in block.words]), shards)
        data = pack(narrow(rising(keys)), narrow(times), narrow(shard), pack_object(block.rows))
        yield messages([(block.name, OWN, 0, data)])


def values_of_words(shard: np.ndarray, answers: dict[int, np.ndarray], dtype: type) -> np.ndarray:
    """The shards' answers in the order of the block's words."""
    out = np.empty(len(shard), dtype)
    for s in np.unique(shard).tolist():
        out[shard == s] = answers[s]
    return out


def split_messages(sent: pd.DataFrame) -> tuple[list[np.ndarray], dict[int, bytes]]:
    """A block's own message and the answers by shard. Fails if a part is missing."""
    own = sent["kind"] == OWN
    if own.sum() != 1:
        raise RuntimeError("answers for a block that the second scan did not make")
    return unpack(sent.loc[own, "data"].iloc[0]), dict(zip(sent.loc[~own, "part"], sent.loc[~own, "data"]))


def _sums(sent: pd.DataFrame, limit: int) -> pd.DataFrame:
    (steps, times, shard, rows), answers = split_messages(sent)
    pieces = values_of_words(shard, {s: unpack(d)[0] for s, d in answers.items()}, np.int64)
    ids, sizes = zip(*unpack_object(rows))
    keys = np.cumsum(steps, dtype=np.int64)
    width = max(1, len(shard))
    totals = np.zeros(len(ids), np.int64)
    np.add.at(totals, keys // width, times * pieces[keys % width])
    out = pd.DataFrame({"doc_id": pd.Series(ids, dtype=object), "n_bytes": sizes, "n_tokens": totals})
    return out.assign(over_limit=out["n_tokens"] > limit)


def count_tokens(docs: DataFrame, path: str, limit: int = 1024, stable: bool = False) -> DataFrame:
    """Tokens of each whole text: ``doc_id, n_bytes, n_tokens, over_limit``.

    The tokenizer is a file of the ``tokenizers`` library that every worker can open; special
    strings inside a text are tokens, none is added. One row per input row, repeated rows and
    NULL ids included; a NULL text counts as empty, with no tokens; an empty table gives no
    rows; other columns of ``docs`` are ignored. ``docs`` are written to the shared folder first,
    unless they are ``stable`` (see ``blocks.settled``). Memory is bounded by a block of documents and
    a shard of units, whatever the length of the text's pieces or the number of documents.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    texts = settled(texts, stable)
    shards = shard_count(texts)
    counted = (
        texts.mapInArrow(partial(distinct_units, shards=shards), MESSAGE)
        .groupBy("to")
        .applyInPandas(lambda key, sent: _piece_counts(key, sent, path), MESSAGE)
    )
    own = texts.mapInArrow(partial(_frequencies, shards=shards), MESSAGE)
    schema = f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean"
    return own.unionByName(counted).groupBy("to").applyInPandas(lambda sent: _sums(sent, limit), schema)
