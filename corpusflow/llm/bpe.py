"""Byte-pair encoding and decoding through a table of distinct words.

Texts are cut into units, each distinct unit is encoded once in the shard of its hash, ids
are joined back by position, and decoding joins ids to the pieces of the vocabulary.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import cache, partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusflow.llm.blocks import (
    ANSWER, MESSAGE, OWN, blocks, hashes, messages, narrow, pack, pack_object, settled, shard_count, shard_of,
    unpack, unpack_object, unpack_words,
)
from corpusflow.llm.token_counts import distinct_units, encoded_once, split_messages, tokenizer, units


def _ids(key: tuple, sent: pd.DataFrame, path: str) -> pd.DataFrame:
    lists = [unpack_words(d) for d in sent["data"]]
    known = dict(encoded_once(lists, path))
    answers = []
    for words in lists:
        found = [known[w] for w in words]
        flat = np.fromiter((i for ids in found for i in ids), np.int64)
        answers.append(pack(narrow(np.fromiter(map(len, found), np.int64, len(found))), narrow(flat)))
    return pd.DataFrame({"to": sent["part"], "kind": ANSWER, "part": key[0], "data": answers})


def _positions(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """Each block keeps the units of its documents by position."""
    for block in blocks(batches, units):
        shard = shard_of(hashes([w.encode() for w in block.words]), shards)
        data = pack(block.run, block.ends, narrow(shard), pack_object(block.rows))
        yield messages([(block.name, OWN, 0, data)])


@cache
def _pieces(path: str) -> list[str]:
    """The id-to-piece table; its size is that of the vocabulary."""
    model = tokenizer(path)
    return [model.id_to_token(i) for i in range(model.get_vocab_size(with_added_tokens=True))]


def _joined(sent: pd.DataFrame, path: str) -> Iterator[tuple]:
    """Per document its columns, the number of tokens, the ids and the pieces, both joined by spaces."""
    (run, ends, shard, rows), answers = split_messages(sent)
    pieces = _pieces(path)
    spelled: list[str] = [""] * len(shard)
    decoded: list[str] = [""] * len(shard)
    counts = np.zeros(len(shard), np.int64)
    for s in np.unique(shard).tolist():
        lengths, flat = unpack(answers[s])
        at, flat = 0, flat.tolist()
        for word, n in zip(np.flatnonzero(shard == s).tolist(), lengths.tolist()):
            ids = flat[at : at + n]
            at += n
            counts[word] = n
            spelled[word] = " ".join(map(str, ids))
            decoded[word] = " ".join([pieces[i] for i in ids])
    start = 0
    for row, end in zip(unpack_object(rows), ends.tolist()):
        words = run[start:end]
        words = words[counts[words] > 0]
        total, words = int(counts[words].sum()), words.tolist()
        yield *row, total, " ".join([spelled[w] for w in words]), " ".join([decoded[w] for w in words])
        start = end


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


#: Result columns: their types, and how they come from the ids and the decoded text.
_RESULTS = {
    "ids": ("array<int>", lambda ids, text: np.array(ids.split(), np.int32)),
    "decoded": ("string", lambda ids, text: text),
    "ids_sha256": ("string", lambda ids, text: _sha256(ids)),
    "decoded_sha256": ("string", lambda ids, text: _sha256(text)),
}
TEXTS, DIGESTS = ("ids", "decoded"), ("ids_sha256", "decoded_sha256")


def _results(sent: pd.DataFrame, path: str, columns: list[str], results: Sequence[str]) -> pd.DataFrame:
    made = [_RESULTS[r][1] for r in results]
    rows = [(*row, *[make(ids, text) for make in made]) for *row, ids, text in _joined(sent, path)]
    return pd.DataFrame(rows, columns=[*columns, "n_tokens", *results], dtype=object)


def encode_decode(
    docs: DataFrame,
    path: str,
    results: Sequence[str] = TEXTS,
    stable: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Encode each whole text and decode it again: ``doc_id``, the columns ``keep``, ``n_tokens`` and ``results``.

    ``path`` names a file of the ``tokenizers`` library without a decoder of its own: decoding
    joins the pieces by spaces, special tokens included; no special token is added. ``results``
    are of ``ids``, ``decoded`` and the SHA-256 digests ``ids_sha256`` (of the decimal ids joined
    by one space) and ``decoded_sha256``; what is not asked for does not leave the Python
    workers. Columns to ``keep`` have plain types.

    One row per input row, repeated rows and NULL ids included; a NULL text counts as empty:
    no ids and an empty text. An empty table gives no rows; other columns are ignored. ``docs``
    are written to the shared folder first, unless they are ``stable`` (see ``blocks.settled``).
    """
    columns = ["doc_id", *keep]
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
    texts = settled(docs.select(*[F.col(f"`{c}`") for c in columns], "text"), stable)
    shards = shard_count(texts)
    encoded = (
        texts.mapInArrow(partial(distinct_units, shards=shards), MESSAGE)
        .groupBy("to")
        .applyInPandas(lambda key, sent: _ids(key, sent, path), MESSAGE)
    )
    messages_ = texts.mapInArrow(partial(_positions, shards=shards), MESSAGE).unionByName(encoded).groupBy("to")
    schema = ", ".join([kinds, "n_tokens long", *[f"{r} {_RESULTS[r][0]}" for r in results]])
    return messages_.applyInPandas(lambda sent: _results(sent, path, columns, results), schema)
