"""Fill-in-the-middle, circulant MinHash and the Merkle manifest against brute force, and on odd rows."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from corpusflow.llm import fill_middle, merkle, minhash
from llm.test_operators import LONG, SCHEMA, collected, rows
from tools.compare import connect, differences
from __spark_entry__ import oracle_sql, queries

UNIT = re.compile("[A-Za-z]+|[^A-Za-z]")
MARKED = ["a <P> b", "x <S>", "<M>", "<", "<P", "P>", "one <two", "a\x00b\r\nc", "😀é́ A-b", "A b c d E", "a B c d e", "TITLE here"]


def every_row():
    extra = [(1000 + i, t, None if i % 2 else "fr", "s", None, "k", 1, "r", 2) for i, t in enumerate(MARKED)]
    return [*rows(), *extra, (None, None, None, None, None, "k", 1, "r", 2), (7, "", "", "", 0, "k", 1, "r", 2)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(every_row(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_they_take_an_empty_table(none):
    assert fill_middle.report(none).count() == 0
    assert minhash.near_duplicates(none).count() == 0
    assert merkle.report(none).count() == 0


# Fill in the middle


def brute_middle(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    h = sha(f"1:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    if h4 % 100 < 20:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_middle_is_brute_force(docs):
    expected = [brute_middle(r[0], r[1]) for r in every_row()]
    assert collected(fill_middle.fill_middle(docs)) == sorted(expected, key=repr)
    shown = [(*e[:5], sha(e[5]), sha(r[1] or "")) for e, r in zip(expected, every_row())]
    assert collected(fill_middle.report(docs)) == sorted(shown, key=repr)
    assert {e[2] for e in expected} == {"plain", "psm", "spm"}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(1, 3000)), max_size=60), st.integers(0, 3))
def test_offsets_are_selected_from_any_container(steps, first):
    gaps = [first << 16, *(g for gap, times in steps for g in [1 + gap * 7] * times)]
    offsets = np.cumsum(np.array(gaps, np.int64))
    held = fill_middle.OffsetSet(offsets)
    assert len(held) == len(offsets)
    for k in {0, len(offsets) // 3, len(offsets) // 2, len(offsets) - 1}:
        assert held.select(k) == offsets[k]


def test_containers_are_the_smallest():
    low = np.arange(65536, dtype=np.uint16)
    assert isinstance(fill_middle.container(low), fill_middle.RunContainer)
    assert isinstance(fill_middle.container(low[::2]), fill_middle.BitmapContainer)
    assert isinstance(fill_middle.container(low[::100]), fill_middle.ArrayContainer)
    assert fill_middle.container(low[::2]).select(20_000) == 40_000


def test_long_texts_use_every_container():
    text = "".join(["a " * 50_000, "1234567890" * 20_000, "word " * 40_000, ("x" * 40 + " ") * 4000, "é"])
    held = fill_middle.boundaries(text)
    ends = np.cumsum([0, *map(len, UNIT.findall(text))])
    assert {type(c).__name__ for c in held.containers} == {"RunContainer", "BitmapContainer", "ArrayContainer"}
    assert [held.select(k) for k in range(0, len(ends), 997)] == ends[::997].tolist() and len(held) == len(ends)


# MinHash


def brute_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))} if words else set()


def brute_components(table):
    """Least id reachable over links of 80 %, ids of one value being one document."""
    sets = [brute_set(t) for _, t in table]
    root = list(range(len(table)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(table)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(table):
        if d is not None:
            least[find(i)].append(d)
    out = []
    for i, (d, _) in enumerate(table):
        c = d if not sets[i] else min(least[find(i)], default=None)
        out.append((d, len(sets[i]), c, d == c))
    return sorted(out, key=repr)


def test_minhash_is_brute_force_on_odd_rows(docs):
    table = [(r[0], r[1]) for r in every_row()]
    assert collected(minhash.near_duplicates(docs)) == brute_components(table)


def near_copies(draw, base, n):
    """Copies of ``base`` with more and more words changed: a chain of links, not a clique."""
    words, out = base.split(), []
    for i in range(n):
        words = list(words)
        words[draw.integers(len(words))] = f"new{i}"
        out.append(" ".join(words))
    return out


def test_minhash_follows_chains_and_large_groups(spark):
    draw = np.random.default_rng(5)
    bases = [" ".join(f"w{k}" for k in draw.integers(0, 3000, 60)) for _ in range(30)]
    texts = [*bases, *near_copies(draw, bases[0], 120), *near_copies(draw, bases[1], 20)]
    texts += [f"{bases[2]} {' '.join(f'v{k}' for k in draw.integers(0, 3000, 30))}" for _ in range(60)]  # a shared passage
    texts += [f"{bases[3]} end{i}" for i in range(150)] + [bases[4]] * 50
    table = list(enumerate(draw.permutation(texts).tolist()))
    found = minhash.near_duplicates(spark.createDataFrame(table, "doc_id long, text string"))
    assert collected(found) == brute_components(table)


def test_signatures_estimate_the_similarity():
    a = np.arange(1, 1001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for shared in (500, 800, 950):
        b = np.concatenate([a[:shared], np.arange(2001, 3001 - shared, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)])
        true = shared / (2000 - shared)
        equal = (minhash.signature(a, 1024) == minhash.signature(b, 1024)).mean()
        assert abs(equal - true) < 4.5 * (true * (1 - true) / 1024) ** 0.5


def test_coordinates_are_shifts_of_one_permutation():
    one = np.array([1 << 40], np.uint64)
    place = minhash._mixed((one >> np.uint64(32)).astype(np.uint32))
    shifted = minhash._mixed(place - np.arange(3, dtype=np.uint32))
    assert (minhash.signature(one)[:3] == shifted).all()
    sample = np.arange(1 << 16, dtype=np.uint32)
    assert len(np.unique(minhash._mixed(sample.copy()))) == len(sample)


# Merkle manifest


def h(parts):
    return sha("".join(parts))


def brute_tree(leaves):
    """Root, and per leaf the siblings of every level as (left, right)."""
    paths, at, nodes = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(nodes) > 1:
        runs = [nodes[i : i + 8] for i in range(0, len(nodes), 8)]
        for leaf, node in enumerate(at):
            run, k = runs[node // 8], node % 8
            paths[leaf].append((run[:k], run[k + 1 :]))
        nodes, at = [h(r) for r in runs], [a // 8 for a in at]
    return nodes[0], paths


def brute_manifest(table):
    def leaf(values):
        return h("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)

    trees = defaultdict(list)
    for doc_id, text, lang, source, n_chars, *_ in table:
        tampered = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        other = re.sub("[A-Z]", lambda m: m[0].lower(), text) if tampered and text is not None else text
        trees[lang].append((doc_id is None, doc_id or 0, *(leaf((doc_id, source, lang, n_chars, t)) for t in (text, other))))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    for lang in langs:
        trees[lang].sort()
    sub = {lang: brute_tree([d for *_, d, _ in trees[lang]]) for lang in langs}
    root, upper = brute_tree([sub[lang][0] for lang in langs])
    out = []
    for lang, above in zip(langs, upper):
        for (missing, doc_id, own, other), path in zip(trees[lang], sub[lang][1]):
            at, siblings = other, []
            for left, right in path + above:
                siblings += left + right
                at = h([*left, at, *right])
            out.append((None if missing else doc_id, own, sub[lang][0], root, h(siblings), at, at == root))
    return sorted(out, key=repr)


def test_manifest_is_brute_force(docs):
    expected = brute_manifest(every_row())
    assert collected(merkle.report(docs)) == expected
    assert {e[-1] for e in expected} == {True, False}


@pytest.mark.parametrize("n", [1, 8, 9, 65, 600])
def test_manifest_of_any_height(spark, n):
    table = [(i, f"Text {i}", None if i % 100 == 7 else f"l{i % 11 if n > 64 else 0}", "s", i, "k", 1, "r", 2) for i in range(n)]
    assert collected(merkle.report(spark.createDataFrame(table, SCHEMA).repartition(4))) == brute_manifest(table)


def test_equal_rows_under_one_id_have_leaves_of_their_own(spark):
    table = [(None, "same Text", "en", "s", 1, "k", 1, "r", 2)] * 50 + [(3, LONG, "en", "s", 1, "k", 1, "r", 2)] * 20
    assert collected(merkle.report(spark.createDataFrame(table, SCHEMA).repartition(4))) == brute_manifest(table)


@pytest.mark.parametrize("name", ["op11_fill_middle", "op12_minhash", "op13_merkle"])
def test_queries_with_sql(spark, sf, name):
    with connect(sf) as con:
        assert differences(queries()[name](spark, sf).toPandas(), con.execute(oracle_sql()[name]).df()) is None
