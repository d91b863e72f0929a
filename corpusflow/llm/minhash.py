"""Near-duplicates by circulant MinHash, with links confirmed on full sets of shingles.

A document's set is its distinct shingles of words, as 64-bit hashes. One permutation of the
32-bit numbers scatters a shingle's hash, a second one is shifted circularly by k places to give
the k-th coordinate: the least value of the set under it. All coordinates come from these two.
Coordinates are cut into bands; sets that agree in a band meet in its bucket.

Buckets are not expanded into pairs. First a leader of each bucket is compared with its members:
by size, by the signatures' low bytes, then on the full sets of what is left. Confirmed links
join components, so most buckets hold one component then. In those that do not, the members
outside the largest component are compared with all members, on full sets, in tiles of bounded
size that emit nothing but links. Every pair of a bucket is either compared or in one component
already: the components are those of all pairs that meet.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from corpusflow.llm.simhash import _components as components
from corpusflow.session import stored

WORDS, PERCENT = 4, 80
#: Coordinates of a band, and bands. At a similarity of 0.8 a pair meets nowhere with a
#: probability of (1 - 0.8 ** 6) ** 40 = 5e-6, at 0.85 with 1e-9.
ROWS, BANDS = 6, 40
#: A pair's share of equal coordinates may stray this many standard errors below its similarity:
#: further off with a probability of 3e-6, as with the bands.
ERRORS = 4.5
#: Sets on either side of a tile.
TILE = 512

_SET = "doc_id {kind}, text_1 long, text_2 long, set_1 long, set_2 long, n_shingles long, bands array<long>, sketch binary"


def _mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of the 32-bit numbers, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def shingles(text: str | None, width: int = WORDS) -> np.ndarray:
    """The distinct shingles, A-Z in lower case, as rising 64-bit hashes; none without words.

    A shingle's hash combines those of its words, each multiplied by a power of an odd number.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    of = {w: xxhash.xxh64_intdigest(w) for w in set(words)}
    found = np.fromiter(map(of.__getitem__, words), np.uint64, len(words))
    width = min(width, len(words))
    n = len(words) - width + 1
    total = np.full(n, width, np.uint64)  # a short sequence is no part of a longer one
    for k in range(width):
        total *= np.uint64(0x9E3779B97F4A7C15)
        total ^= found[k : k + n]
        total ^= total >> np.uint64(29)
        total *= np.uint64(0xBF58476D1CE4E5B9)
        total ^= total >> np.uint64(32)
    return np.unique(total)


def signature(found: np.ndarray, coordinates: int = ROWS * BANDS, rows: int = 256) -> np.ndarray:
    """The least places of a set under all circular shifts of the second permutation."""
    with np.errstate(over="ignore"):
        place = _mixed((found >> np.uint64(32)).astype(np.uint32))  # the first permutation
        shift = np.arange(coordinates, dtype=np.uint32)
        least = np.full(coordinates, np.uint32(0xFFFFFFFF))
        for at in range(0, len(place), rows):
            np.minimum(least, _mixed(place[at : at + rows, None] - shift).min(axis=0), out=least)
    return least


def band_keys(least: np.ndarray, rows: int = ROWS) -> list[int]:
    data = least.reshape(-1, rows)
    return np.array([xxhash.xxh64_intdigest(band.tobytes(), j) for j, band in enumerate(data)], np.uint64).view(np.int64).tolist()


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text in batch.column(3):
            found = shingles(text.as_py())
            if not len(found):
                out.append((None, None, 0, [], b""))
                continue
            least, key = signature(found), xxhash.xxh3_128_digest(found.tobytes())
            first, second = np.frombuffer(key, np.int64).tolist()
            out.append((first, second, len(found), band_keys(least), least.astype(np.uint8).tobytes()))
        columns = list(zip(*out)) or [()] * 5
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())
        arrays = [*(batch.column(i) for i in range(3)), *(pa.array(c, k) for c, k in zip(columns, kinds))]
        names = ["doc_id", "text_1", "text_2", "set_1", "set_2", "n_shingles", "bands", "sketch"]
        yield pa.RecordBatch.from_arrays(arrays, names=names)


def _text_keys() -> list[Column]:
    return [F.xxhash64("text").alias("text_1"), F.xxhash64(F.lit(1), "text").alias("text_2")]


def _alike(near: float) -> np.ndarray:
    """By the number of shared coordinates, out of all: whether the similarity may reach ``near``."""
    n = ROWS * BANDS
    least = near - ERRORS * sqrt(near * (1 - near) / n)
    return np.arange(n + 1) >= least * n


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sketches leave room for the similarity."""
    n, enough = ROWS * BANDS, _alike(PERCENT / 100)
    for batch in batches:
        if batch.num_rows:
            left, right = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, n) for i in (2, 3))
            keep = pa.array(enough[(left == right).sum(axis=1)])
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(keep) for i in (0, 1)], names=["a", "b"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = pa.array([shingles(t.as_py()).tobytes() for t in batch.column(1)], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), found], names=["node", "shingles"])


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose full sets share enough of their union."""
    for batch in batches:
        keep = []
        for one, other in zip(batch.column(2), batch.column(3)):
            a, b = (np.frombuffer(x.as_py(), np.uint64) for x in (one, other))
            if len(a) > len(b):
                a, b = b, a
            at = np.minimum(np.searchsorted(b, a), len(b) - 1)
            common = int((b[at] == a).sum())
            keep.append(100 * common >= PERCENT * (len(a) + len(b) - common))
        keep = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(i).filter(keep) for i in (0, 1)], names=["a", "b"])


def _star(members: DataFrame) -> DataFrame:
    """Pairs of each bucket's leader with its other members, each pair once."""
    order = F.struct(F.xxhash64("node").alias("order"), "node", "n")  # one order, so buckets share their leaders
    leaders = members.groupBy("key").agg(F.min(order).alias("l")).select("key", F.col("l.node").alias("v"), F.col("l.n").alias("nv"))
    met = members.join(leaders, "key").filter("node <> v")
    met = met.filter(100 * F.least("n", "nv") >= PERCENT * F.greatest("n", "nv"))
    return met.select(F.least("node", "v").alias("a"), F.greatest("node", "v").alias("b")).distinct()


def _tiles(members: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows ``key, a, b, own, node, root`` of the tiles of buckets with several components.

    ``own`` marks the members outside the bucket's largest component. They are dealt by a hash
    over the tiles' rows ``a``, all members over the columns ``b``; a tile holds one of each.
    """
    now = members.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    sizes = now.groupBy("key", "root").agg(F.count("*").alias("size"))
    most = sizes.groupBy("key").agg(F.max(F.struct("size", "root")).alias("most"), F.sum("size").alias("members"))
    sides = most.filter(F.col("members") > F.col("most.size")).select(
        "key",
        F.col("most.root").alias("largest"),
        F.ceil((F.col("members") - F.col("most.size")) / TILE).alias("rows"),
        F.ceil(F.col("members") / TILE).alias("columns"),
    )
    left = now.join(sides, "key")

    def dealt(side: str) -> Column:
        return F.pmod(F.xxhash64("node"), side)

    def each(side: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(side) - 1))

    own = left.filter("root <> largest").select("key", dealt("rows").alias("a"), each("columns").alias("b"), F.lit(True).alias("own"), "node", "root")
    others = left.select("key", each("rows").alias("a"), dealt("columns").alias("b"), F.lit(False).alias("own"), "node", "root")
    return own.unionByName(others)


def _linked(own: np.ndarray, nodes: np.ndarray, roots: np.ndarray, sets: list[np.ndarray]) -> np.ndarray:
    """Links between the two sides of a tile, across components, as pairs of nodes."""
    others, out = np.flatnonzero(~own), [np.empty((0, 2), np.int64)]
    if len(others):
        sizes = np.array([len(sets[i]) for i in others])
        known, flat = np.unique(np.concatenate([sets[i] for i in others]), return_inverse=True)
        starts = np.cumsum(sizes) - sizes
        for i in np.flatnonzero(own):
            mine = sets[i]
            at = np.minimum(np.searchsorted(known, mine), len(known) - 1)
            held = np.zeros(len(known), np.int64)
            held[at[known[at] == mine]] = 1
            common = np.add.reduceat(held[flat], starts)
            near = (100 * common >= PERCENT * (len(mine) + sizes - common)) & (roots[others] != roots[i])
            found = nodes[others[near]]
            out.append(np.stack([np.minimum(found, nodes[i]), np.maximum(found, nodes[i])], axis=1))
    return np.concatenate(out)


def _tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of all tiles, whose rows come one tile after the other."""

    def links(table: pa.Table, starts: list[int], ends: list[int]) -> pa.RecordBatch:
        own, nodes, roots = (table[c].to_numpy() for c in ("own", "node", "root"))
        sets = [np.frombuffer(x, np.uint64) for x in table["shingles"].to_pylist()]
        found = [np.empty((0, 2), np.int64)]
        found += [_linked(own[a:b], nodes[a:b], roots[a:b], sets[a:b]) for a, b in zip(starts, ends)]
        pairs = np.concatenate(found)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        rest = table if rest is None else pa.concat_tables([rest, table])
        if rest.num_rows:
            where = [rest[c].to_numpy() for c in ("key", "a", "b")]
            cuts = np.flatnonzero(np.any([np.diff(w) != 0 for w in where], axis=0)) + 1
            starts = [0, *cuts.tolist()]
            yield links(rest.slice(0, starts[-1]), starts[:-1], starts[1:])
            rest = rest.slice(starts[-1])  # the last tile may go on
    if rest is not None and rest.num_rows:
        yield links(rest, [0], [rest.num_rows])


def _with_both(pairs: DataFrame, of: DataFrame, value: str) -> DataFrame:
    """Pairs with ``value`` of both ends; Spark splits the rows of an end with many pairs."""
    left, right = (of.select(F.col("node").alias(e), F.col(value).alias(f"{value}_{e}")) for e in ("a", "b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", f"{value}_a", f"{value}_b")


def _full(nodes: DataFrame, sets: DataFrame, docs: DataFrame) -> DataFrame:
    """``node, shingles`` of the nodes, made again from a text of each."""
    wanted = sets.select("node", "text_1", "text_2").join(nodes.distinct(), "node")
    whole = docs.select(*_text_keys(), "text").join(wanted, ["text_1", "text_2"]).dropDuplicates(["node"])
    return whole.select("node", "text").mapInArrow(_sets, "node long, shingles binary")


def _roots(sets: DataFrame, docs: DataFrame) -> DataFrame:
    """``node, root`` of the nodes that links connect, over all similar pairs of all buckets.

    ``sets`` has ``node, text_1, text_2, n_shingles, bands, sketch``.
    """
    keys = sets.select("node", F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("rows")).filter("rows > 1").select("key")
    members = stored(keys.join(shared, "key").select("key", "node", "n"), "minhash-members")

    near = _with_both(_star(members), sets.select("node", "sketch"), "sketch").mapInArrow(_sketched, "a long, b long")
    near = stored(near, "minhash-near")
    full = _full(near.select(F.explode(F.array("a", "b")).alias("node")), sets, docs)
    links = stored(_with_both(near, full, "shingles").mapInArrow(_confirmed, "a long, b long"), "minhash-links")

    tiles = stored(_tiles(members, components(links)), "minhash-tiles")
    held = tiles.join(_full(tiles.select("node"), sets, docs), "node").repartition("key", "a", "b")
    more = held.sortWithinPartitions("key", "a", "b").mapInArrow(_tiled, "a long, b long").distinct()
    return components(links.unionByName(more))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row.

    Sets of four-word shingles (A-Z in lower case) that share 80 % of their union are linked;
    ``component_id`` is the least ``doc_id`` that links reach. Equal sets are one set from the
    start. A text without words, or NULL, has an empty set and is linked with nothing but its
    own id. One row per input row, repeated rows included. NULL ids never are a component's id
    unless it has no other: then it is NULL, and ``kept`` is true. An empty table gives no rows;
    other columns are ignored. A text has to fit in a task's memory.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", *_text_keys(), "text")
    signed = stored(rows.mapInArrow(_signed, _SET.format(kind=kind)), "minhash-signed")
    key = ["set_1", "set_2"]
    some = signed.filter("n_shingles > 0")
    same = [F.first(c).alias(c) for c in ("n_shingles", "bands", "sketch")]
    sets = some.groupBy(*key).agg(F.min("doc_id").alias("first"), F.min(F.struct("text_1", "text_2")).alias("text"), *same)
    sets = sets.withColumn("node", F.monotonically_increasing_id())  # fixed by the table
    sets = stored(sets.select("*", "text.text_1", "text.text_2").drop("text"), "minhash-sets")
    roots = _roots(sets, docs)
    of = sets.select(*key, "node", "first").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = of.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = of.join(ids, "root").select(*key, "component_id")
    empty = signed.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    found = some.join(classes, key).select("doc_id", "n_shingles", "component_id").unionByName(empty)
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


ORACLE = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
  FROM words
), shingles AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
)
SELECT s.doc_id, len(s.s) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM sets s JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) c USING (doc_id)
"""
