"""Near-duplicates by 64-bit fingerprints, with tables of distances to pivots.

Every distinct fingerprint carries its Hamming distances to fixed reference fingerprints. Two
fingerprints differ in at least as many bits as any of their coordinates, so a pair whose
largest coordinate difference is over the limit is discarded before its bits are compared.
Pairs meet in groups with equal bits in three of seven stretches: four differing bits leave
three stretches alike at least, so none is lost. A group yields a star per component, never
its pairs; groups beyond ``GROUP`` members meet in their variants of two flipped bits instead.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from corpusflow.session import stored

WORDS, SEED, DISTANCE = 4, 42, 4
STRETCHES, EQUAL = 7, 3
#: Pivots of a fingerprint, their distances packed in two numbers of eight bytes.
PIVOTS = 16
#: Members of a group that are compared in one task; larger groups go the other way.
GROUP = 4096


def fingerprint(text: str | None) -> int:
    """Bits that are set in over half the hashes of the shingles; zero for no words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    n = max(1, len(words) - WORDS + 1)
    last = ends[-n:]
    digest = xxhash.xxh64_intdigest
    found = (digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), last.tolist()))
    return majority(np.fromiter(found, np.uint64, n))


def majority(found: np.ndarray, rows: int = 65536) -> int:
    ones = np.zeros(64, np.int64)
    for at in range(0, len(found), rows):
        bits = np.unpackbits(found[at : at + rows].view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > len(found), bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.fromiter((fingerprint(t.as_py()) for t in batch.column(1)), np.uint64, batch.num_rows)
        arrays = [batch.column(0), batch.column(2), pa.array(found.view(np.int64))]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "text_key", "bits"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, bits`` per row, with the hash of the text; NULL texts count as empty."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    return rows.mapInArrow(_fingerprints, f"doc_id {kind}, text_key long, bits long")


def pivots() -> list[int]:
    """Reference fingerprints: hashes of the numbers from 0."""
    return [np.uint64(xxhash.xxh64_intdigest(str(i), SEED)).astype(np.int64).item() for i in range(PIVOTS)]


def _distances(bits: Column) -> list[Column]:
    """Distances to the pivots, a byte each."""
    found = [F.bit_count(bits.bitwiseXOR(F.lit(p))).cast("long") for p in pivots()]
    packed = []
    for half in (found[: PIVOTS // 2], found[PIVOTS // 2 :]):
        total = half[0]
        for k, d in enumerate(half[1:], 1):
            total = total.bitwiseOR(F.shiftleft(d, 8 * k))
        packed.append(total)
    return packed


def _groups(bits: Column) -> Column:
    """One key for every choice of stretches that may be equal."""
    cuts = [64 * k // STRETCHES for k in range(STRETCHES + 1)]
    keys = []
    for which, chosen in enumerate(combinations(range(STRETCHES), EQUAL)):
        key = F.lit(which).cast("long")
        for k in chosen:
            width = cuts[k + 1] - cuts[k]
            part = F.shiftrightunsigned(bits, cuts[k]).bitwiseAND(F.lit((1 << width) - 1))
            key = F.shiftleft(key, width).bitwiseOR(part)
        keys.append(key)
    return F.explode(F.array(*keys))


def _near(bits: np.ndarray, distances: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a group within the limit, by the pivots and then by their bits."""
    order = np.argsort(distances[:, 0], kind="stable")
    first = distances[order, 0].astype(np.int64)
    until = np.searchsorted(first, first + DISTANCE, side="right")
    left, right = [], []
    for at in range(0, len(order), 512):
        rows = np.arange(at, min(at + 512, len(order)))
        times = until[rows] - rows - 1
        a = np.repeat(rows, times)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(times) - times, times)
        a, b = order[a], order[b]
        for k in range(1, distances.shape[1]):
            near = np.abs(distances[a, k].astype(np.int16) - distances[b, k]) <= DISTANCE
            a, b = a[near], b[near]
        near = np.bitwise_count(bits[a] ^ bits[b]) <= DISTANCE
        left.append(a[near])
        right.append(b[near])
    return np.concatenate(left), np.concatenate(right)


def _labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    labels = np.arange(n)
    while True:
        low = np.minimum(labels[a], labels[b])
        new = labels.copy()
        np.minimum.at(new, labels[a], low)
        np.minimum.at(new, labels[b], low)
        new = new[new]
        if (new == labels).all():
            return labels
        labels = new


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links from the members of each group's components to one of them. Rows come by key."""

    def links(keys: np.ndarray, bits: np.ndarray, distances: np.ndarray) -> pa.RecordBatch:
        cuts = np.flatnonzero(np.diff(keys, prepend=keys[0])) if len(keys) else np.empty(0, int)
        a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
            if end - start > 1:
                own = bits[start:end]
                labels = _labels(end - start, *_near(own, distances[start:end]))
                linked = np.flatnonzero(labels != np.arange(end - start))
                a.append(own[linked].view(np.int64))
                b.append(own[labels[linked]].view(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    rest = (np.empty(0, np.int64), np.empty(0, np.uint64), np.empty((0, PIVOTS), np.uint8))
    for batch in batches:
        key, bits, p, q = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        bytes_ = np.stack([p, q], axis=1).astype(np.int64).view(np.uint8).reshape(-1, PIVOTS)
        own = (key, bits.astype(np.int64).view(np.uint64), bytes_)
        rest = tuple(np.concatenate(x) for x in zip(rest, own))
        if len(rest[0]):
            whole = int(np.searchsorted(rest[0], rest[0][-1]))  # the last group may go on
            yield links(*(x[:whole] for x in rest))
            rest = tuple(x[whole:] for x in rest)
    yield links(*rest)


def _links(distinct: DataFrame) -> DataFrame:
    """Links that connect what pairs within the limit connect.

    Joins of exploded rows are merged: Spark sizes those by the rows before, and would broadcast them.
    """
    p, q = _distances(F.col("bits"))
    members = distinct.select("bits", p.alias("p"), q.alias("q")).select(_groups(F.col("bits")).alias("key"), "bits", "p", "q")
    sizes = members.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    grouped = stored(members.join(sizes.hint("merge"), "key"), "groups")
    small = grouped.filter(F.col("n") <= GROUP).select("key", "bits", "p", "q")
    near = small.repartition("key").sortWithinPartitions("key").mapInArrow(_stars, "a long, b long")

    flips = [0] + [1 << i for i in range(64)] + [1 << i | 1 << j for i, j in combinations(range(64), 2)]
    masks = F.array(*[F.lit(np.uint64(m).astype(np.int64).item()) for m in flips])
    hot = grouped.filter(F.col("n") > GROUP).select("bits").distinct()
    variants = hot.select("bits", F.explode(F.transform(masks, lambda m: F.col("bits").bitwiseXOR(m))).alias("variant"))
    centres = variants.groupBy("variant").agg(F.min("bits").alias("b"))
    met = variants.join(centres.hint("merge"), "variant").select(F.col("bits").alias("a"), "b").filter("a <> b")
    return near.unionByName(met).distinct()


def _components(links: DataFrame) -> DataFrame:
    """``node, root`` of every linked node, by alternating large and small stars."""

    def star(pairs: DataFrame) -> DataFrame:
        """``pairs`` of u and v: links of every v, and of u, to the least node around u."""
        least = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        return pairs.join(least, "u")

    def state(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    edges = stored(links.filter("a <> b"), "links")
    last = state(edges)
    while last[0]:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
        both = both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = star(both).filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
        stars = star(down)
        small = stars.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            stars.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
        edges = stored(small.filter("a <> b").distinct(), "links")
        now = state(edges)
        if now == last:
            break
        last = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, fingerprint, component_id, root`` per row.

    Fingerprints of four-word shingles (A-Z in lower case, repeats included) are linked if they
    differ in at most four bits. ``component_id`` is the least ``doc_id`` that links reach,
    ``root`` a fingerprint that stands for the component.

    Repeated rows stay; NULL and empty texts have fingerprint zero, which is linked like any
    other. NULL ids never are a component's id, unless it has no other: then it is NULL. An
    empty table gives no rows; other columns of ``docs`` are ignored.
    """
    found = stored(fingerprints(docs), "fingerprints")
    distinct = found.groupBy("bits").agg(F.min("doc_id").alias("first"))
    roots = _components(_links(distinct.select("bits")))
    of = distinct.join(roots, F.col("bits") == F.col("node"), "left").select(
        "bits", "first", F.coalesce("root", "bits").alias("root")
    )
    ids = of.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = of.select("bits", "root").join(ids, "root")
    return found.join(classes, "bits").select(
        "doc_id",
        "text_key",
        F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"),
        "component_id",
        F.lower(F.lpad(F.hex("root"), 16, "0")).alias("root"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, with one row for each component: the one with the
    least id, of equal ids the one with the least hash of its text, of equal rows any."""
    keep = (
        near_duplicates(docs)
        .filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root")
        .agg(F.min(F.struct("doc_id", "text_key")).alias("_key"))
        .select("_key")
    )
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.struct(F.col("doc_id"), F.xxhash64("text").alias("text_key")).alias("_own"),
    )
    kept = rows.join(keep, F.col("_own").eqNullSafe(F.col("_key")), "left_semi").dropDuplicates(["_own"])
    return kept.select(*[F.col("_row")[c].alias(c) for c in docs.columns])
