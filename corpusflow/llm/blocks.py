"""Blocks of documents, shards of keys, and the packed messages between them.

A block is a stretch of documents within one scan task, bounded in code points. It numbers its
distinct words once and holds every document as a run of numbers. What has to be known about
a word (or a pair of words) in the whole corpus is worked out in the shard that its hash falls
into: blocks send their distinct keys to the shards, shards answer each block. Both steps are
Spark shuffles of rows ``(to, kind, part, data)`` grouped by ``to``, with arrays packed in
``data``. Hashes spread evenly, and a common word comes once from each block, so no shard is hot.

Blocks depend only on the rows of the scan task, in their order. Operators scan their rows more
than once, so the rows have to come alike each time: ``settled`` writes rows that may not.
"""

from __future__ import annotations

import pickle
import struct
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from corpusflow.session import stored

MESSAGE = "to long, kind int, part long, data binary"
#: Code points of one block (one document at least), UTF-8 bytes of text per shard.
BLOCK_CHARS = 32_000_000
SHARD_BYTES = 8_000_000
#: Kind of the message in which a block keeps its own documents; answers come after it.
OWN, ANSWER = 0, 1


def shard_count(docs: DataFrame, column: str = "text", shard_bytes: int = SHARD_BYTES) -> int:
    """Shards that keep each one's share of the keys bounded."""
    total = docs.agg(F.sum(F.octet_length(column)).alias("n")).first()["n"] or 0
    return max(1, -(-total // shard_bytes))


def settled(rows: DataFrame, stable: bool) -> DataFrame:
    """Rows that every scan gives alike, task by task.

    Rows behind a shuffle may come otherwise in a second scan or in a task that runs again, so
    they are written to the shared folder first. ``stable`` promises that there is no need to,
    as with a table just read from files.
    """
    return rows if stable else stored(rows, "texts")


def narrow(values: np.ndarray) -> np.ndarray:
    """The same non-negative integers in the smallest type that holds them."""
    return values.astype(np.min_scalar_type(int(values.max())) if len(values) else np.uint8)


def rising(values: np.ndarray) -> np.ndarray:
    """A rising sequence as its steps; ``np.cumsum`` in the same type gives it back."""
    return np.diff(values, prepend=values.dtype.type(0))


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers as compressed byte planes."""
    out = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        planes = a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() if len(a) else b""
        body = pa.compress(planes, codec="zstd", asbytes=True) if planes else b""
        out.append(struct.pack("<2sQQ", a.dtype.str[1:3].encode(), len(a), len(body)) + body)
    return b"".join(out)


def unpack(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        kind, n, size = struct.unpack_from("<2sQQ", data, at)
        at += 18
        dtype = np.dtype("<" + kind.decode())
        if n:
            planes = pa.decompress(data[at : at + size], n * dtype.itemsize, codec="zstd", asbytes=True)
            out.append(np.frombuffer(planes, np.uint8).reshape(dtype.itemsize, n).T.copy().view(dtype).ravel())
        else:
            out.append(np.empty(0, dtype))
        at += size
    return out


def pack_object(value: object) -> np.ndarray:
    """Any small Python value as bytes for ``pack``."""
    return np.frombuffer(pickle.dumps(value, protocol=5), np.uint8)


def unpack_object(data: np.ndarray) -> object:
    return pickle.loads(data.tobytes())


def pack_words(words: list[bytes]) -> bytes:
    return pack(narrow(np.fromiter(map(len, words), np.int64, len(words))), np.frombuffer(b"".join(words), np.uint8))


def unpack_words(data: bytes) -> list[bytes]:
    lengths, joined = unpack(data)
    ends = np.cumsum(lengths, dtype=np.int64)
    joined = joined.tobytes()
    return [joined[b - n : b] for b, n in zip(ends.tolist(), lengths.tolist())]


class Block:
    """Documents of one stretch: their other columns, and their words as numbers."""

    def __init__(self, name: int, first: tuple = ()):
        self.name, self.chars, self.rows, self._runs = name, 0, [], []
        self._numbers: defaultdict = defaultdict()
        self._numbers.default_factory = self._numbers.__len__
        for word in first:
            self._numbers[word]

    def add(self, row: tuple, words: list, chars: int) -> None:
        self.rows.append(row)
        self._runs.append(np.fromiter(map(self._numbers.__getitem__, words), np.int32, len(words)))
        self.chars += chars

    def finish(self) -> Block:
        """``words`` in order of first use, ``run`` of all documents, ``ends`` of each."""
        self.words = list(self._numbers)
        self.ends = np.cumsum([len(r) for r in self._runs], dtype=np.int64)
        self.run = np.concatenate(self._runs) if self._runs else np.empty(0, np.int32)
        del self._runs, self._numbers
        return self

    def documents(self) -> np.ndarray:
        """The document of each word of the run."""
        return np.repeat(np.arange(len(self.ends)), np.diff(self.ends, prepend=0))


def blocks(
    batches: Iterable[pa.RecordBatch],
    words: Callable[[str], list],
    size: int = BLOCK_CHARS,
    first: tuple = (),
) -> Iterator[Block]:
    """Blocks of the rows of one task; the last column is the text, NULL counts as empty."""
    context, number, block = TaskContext.get(), 0, None
    task = context.partitionId() if context else 0
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        for *row, text in zip(*columns):
            text = text or ""
            block = block or Block(task << 32 | number, first)
            block.add(tuple(row), words(text), len(text))
            if block.chars >= size:
                yield block.finish()
                block, number = None, number + 1
    if block:
        yield block.finish()


def hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w) for w in words), np.uint64, len(words))


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of a 64-bit hash, by its upper half."""
    return ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def messages(rows: Iterable[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    to, kind, part, data = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(to, pa.int64()), pa.array(kind, pa.int32()), pa.array(part, pa.int64()), pa.array(data, pa.binary())],
        names=["to", "kind", "part", "data"],
    )


def arrow_type(docs: DataFrame) -> pa.DataType:
    """The Arrow type of ids: whole numbers or text."""
    whole = {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8()}
    return {**whole, "string": pa.string()}[docs.schema["doc_id"].dataType.simpleString()]
