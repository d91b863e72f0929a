"""Text embedding in Arrow batches with an exchangeable encoder."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

# An encoder maps texts to a matrix of unit vectors, one row per text. A factory builds it.
Encoder = Callable[[Sequence[str]], np.ndarray]
EncoderFactory = Callable[[], Encoder]

_EPS = 1e-12
_VOCABULARY_LIMIT = 200_000
#: Rows of an Arrow batch that are encoded at a time.
PIECE_ROWS = 1024
_built: dict[str, Encoder] = {}


def masked_mean(states: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Mean over the unmasked positions of ``(texts, positions, dim)``."""
    weights = mask[..., None].astype(np.float64)
    return (states * weights).sum(axis=1) / np.maximum(weights.sum(axis=1), 1.0)


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; zero rows stay zero."""
    return matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), _EPS)


class TokenHashEncoder:
    """Model-free encoder: every token's md5 bytes become odd components from -255 to 255.

    The sum over the tokens is exact, so a vector does not depend on its batch. Stands in
    where no model weights are at hand.
    """

    def __init__(self, dim: int = 16, max_tokens: int | None = None):
        if not 1 <= dim <= 16:
            raise ValueError("an md5 digest has 16 bytes")
        self.dim, self.max_tokens = dim, max_tokens
        self._forget()

    def _forget(self) -> None:
        self._rows: dict[str, int] = {}
        self._components = np.zeros((0, self.dim), dtype=np.int16)

    def _learn(self, tokens: list[str]) -> None:
        digests = b"".join([hashlib.md5(t.encode()).digest()[: self.dim] for t in tokens])
        components = 2 * np.frombuffer(digests, dtype=np.uint8).astype(np.int16).reshape(-1, self.dim) - 255
        start = len(self._rows)
        while start + len(tokens) > len(self._components):
            more = np.zeros((max(4096, len(self._components)), self.dim), dtype=np.int16)
            self._components = np.vstack([self._components, more])
        self._components[start : start + len(tokens)] = components
        self._rows.update(zip(tokens, range(start, start + len(tokens))))

    def __call__(self, texts: Sequence[str]) -> np.ndarray:
        if len(self._rows) > _VOCABULARY_LIMIT:
            self._forget()
        words = [t.split()[: self.max_tokens] for t in texts]
        flat = list(chain.from_iterable(words))
        unseen = list(set(flat).difference(self._rows))
        if unseen:
            self._learn(unseen)
        at = np.fromiter(map(self._rows.__getitem__, flat), dtype=np.int64, count=len(flat))
        counts = np.array([len(w) for w in words])
        means = np.zeros((len(words), self.dim))
        if len(flat):
            starts = (np.cumsum(counts) - counts)[counts > 0]
            sums = np.add.reduceat(self._components[at], starts, axis=0, dtype=np.int64)
            means[counts > 0] = sums / counts[counts > 0][:, None]
        return unit_rows(means)


class TokenHash:
    """Factory of :class:`TokenHashEncoder`."""

    def __init__(self, dim: int = 16, max_tokens: int | None = None):
        self.dim, self.max_tokens = dim, max_tokens
        self.cache_key = f"token-hash-{dim}-{max_tokens}"

    def __call__(self) -> TokenHashEncoder:
        return TokenHashEncoder(self.dim, self.max_tokens)


def _encoder(factory: EncoderFactory) -> Encoder:
    """Built once per Python worker when the factory names a ``cache_key``."""
    key = getattr(factory, "cache_key", None)
    if key is None:
        return factory()
    if key not in _built:
        _built[key] = factory()
    return _built[key]


def _checked(found: object, n: int, width: int | None) -> np.ndarray:
    """The encoder's result as a matrix of ``n`` rows; anything else is a fault of the whole batch."""
    matrix = np.asarray(found, dtype=np.float64)
    if matrix.ndim != 2 or len(matrix) != n:
        raise ValueError(f"{n} texts gave an array of shape {matrix.shape}")
    if width is not None and matrix.shape[1] != width:
        raise ValueError(f"vectors of {matrix.shape[1]} numbers, {width} expected")
    return matrix


class _Vectors:
    """Vectors and errors of one batch of rows, in input order, all of one width."""

    def __init__(self, n: int, width: int | None):
        self.width, self.matrix, self.errors = width, None, [None] * n

    def put(self, rows: Sequence[int], found: object) -> None:
        matrix = _checked(found, len(rows), self.width)
        if self.matrix is None:
            self.width = matrix.shape[1]
            self.matrix = np.zeros((len(self.errors), self.width))
        self.matrix[rows] = matrix
        for i, fine in zip(rows, np.isfinite(matrix).all(axis=1)):
            self.errors[i] = None if fine else "vector is not finite"

    def arrow(self, kind: pa.DataType) -> pa.Array:
        """A list per row, none where there is an error."""
        n, width = len(self.errors), self.width or 0
        missing = np.array([e is not None for e in self.errors], dtype=bool)
        kept = self.matrix[~missing] if self.matrix is not None else np.zeros((0, 0))
        offsets = np.concatenate([[0], np.cumsum(~missing) * width]).astype(np.int32)
        values = pa.array(kept.ravel(), type=kind)
        return pa.ListArray.from_arrays(pa.array(offsets), values, mask=pa.array(missing) if n else None)


def _by_length(encoder: Encoder, texts: list[str], batch_size: int, width: int | None) -> _Vectors:
    """Vectors and error messages in input order.

    Batches hold texts of similar length to save padding. A batch that fails, or whose result
    is not one vector of the right width for each text, is tried again text by text, so that one
    bad text does not take the others with it.
    """
    out = _Vectors(len(texts), width)
    order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
    for start in range(0, len(order), batch_size):
        batch = order[start : start + batch_size]
        try:
            out.put(batch, encoder([texts[i] for i in batch]))
        except Exception:
            for i in batch:
                try:
                    out.put([i], encoder([texts[i]]))
                except Exception as failure:
                    out.errors[i] = str(failure)
    return out


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, bool]]:
    """Batches in pieces whose texts are in memory at a time, and whether a piece of the same batch came before."""
    for batch in batches:
        for start in range(0, batch.num_rows, PIECE_ROWS):
            yield batch.slice(start, PIECE_ROWS), start > 0


def embed(
    df: DataFrame,
    text: str,
    factory: EncoderFactory | None = None,
    prefix: str = "",
    batch_size: int = 32,
    keep: Sequence[str] | None = None,
    tasks: int | None = None,
    width: int | None = None,
    numbers: str = "double",
) -> DataFrame:
    """Columns ``keep`` with ``embeddings`` and ``error`` added.

    Rows are encoded where they are read, without a shuffle, unless ``tasks`` says over how
    many tasks to spread them first. Rows stream through as Arrow batches, whose other columns
    are passed on as they are, so memory does not grow with the partition. The text itself stays
    behind unless ``keep`` names it.

    Every row has a vector of finite numbers or an ``error``, never neither. Vectors have
    ``width`` numbers, by default the factory's ``dim``, else as many as the first one of a batch
    of rows. ``numbers`` is double, or float for half the bytes.
    """
    factory = factory or TokenHash()
    width = width or getattr(factory, "dim", None)
    keep = list(keep if keep is not None else [c for c in df.columns if c != text])
    number, arrow = {"double": (T.DoubleType(), pa.float64()), "float": (T.FloatType(), pa.float32())}[numbers]
    schema = T.StructType(
        [df.schema[c] for c in keep]
        + [T.StructField("embeddings", T.ArrayType(number)), T.StructField("error", T.StringType())]
    )
    carried = [c for c in keep if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(factory)
        for batch, of_batch in _pieces(batches):
            texts = batch.column(len(carried))
            known = width or (found.width if of_batch else None)
            found = _by_length(encoder, [prefix + t for t in texts.to_pylist()], batch_size, known)
            others = {c: batch.column(i) for i, c in enumerate(carried)} | {text: texts}
            arrays = [*(others[c] for c in keep), found.arrow(arrow), pa.array(found.errors, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, "embeddings", "error"])

    present = df.filter(F.col(text).isNotNull())
    present = present.repartition(tasks) if tasks else present
    return present.select(*carried, F.col(text).alias("_text")).mapInArrow(run, schema)


def token_count(text: Column, max_tokens: int | None = None) -> Column:
    n = F.regexp_count(text, F.lit(r"[^\s]+"))
    return F.least(n, F.lit(max_tokens)) if max_tokens else n


def truncated(tokens: Column, max_tokens: int) -> Column:
    """First tokens of a token array, for encoders that take tokens."""
    return F.slice(tokens, 1, max_tokens)


def prefixed(text: Column, prefix: str) -> Column:
    return F.concat(F.lit(prefix), text)
