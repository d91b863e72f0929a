import inspect
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from checks.queries import QUERIES
from corpusflow.operators import neighbors, projection


def brute_force(ids, matrix, k):
    d = np.round(np.sqrt(np.maximum(((matrix[:, None] - matrix[None]) ** 2).sum(-1), 0)), 6)
    out = {}
    for a, i in enumerate(ids):
        order = sorted((d[a, b], j) for b, j in enumerate(ids) if j != i)[:k]
        out[int(i)] = [(int(j), float(x)) for x, j in order]
    return out


def graph_of(df):
    out = {}
    for r in df.orderBy("i", "rk").collect():
        out.setdefault(r["i"], []).append((r["j"], r["d"]))
    return out


def frame(spark, ids, matrix):
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(ids, matrix)]
    return spark.createDataFrame(rows, "id long, v array<double>").repartition(5)


def same(found, expected):
    assert found.keys() == expected.keys()
    for i, near in expected.items():
        assert [j for j, _ in found[i]] == [j for j, _ in near], i
        assert [d for _, d in found[i]] == pytest.approx([d for _, d in near], abs=2e-6)


@pytest.mark.parametrize("kind", ["spread", "clustered"])
def test_exact_over_many_blocks(spark, kind):
    rng = np.random.default_rng(1)
    matrix = rng.normal(size=(300, 6))
    if kind == "clustered":
        matrix = np.repeat(rng.normal(size=(6, 6)) * 50, 50, axis=0) + matrix
    ids = rng.permutation(5000)[:300]
    same(graph_of(neighbors.knn_graph(frame(spark, ids, matrix), "id", "v", 7, block_rows=25)), brute_force(ids, matrix, 7))


def test_a_third_of_all_rows_are_copies(spark):
    rng = np.random.default_rng(2)
    matrix = rng.normal(size=(150, 4))
    matrix[::3] = matrix[0]
    matrix[1::30] = matrix[1]
    ids = rng.permutation(1000)[:150]
    same(graph_of(neighbors.knn_graph(frame(spark, ids, matrix), "id", "v", 6, block_rows=20)), brute_force(ids, matrix, 6))


def test_fewer_vectors_than_neighbours(spark):
    same(
        graph_of(neighbors.knn_graph(frame(spark, [5, 6, 7], np.eye(3)), "id", "v", 15)),
        brute_force([5, 6, 7], np.eye(3), 15),
    )
    assert neighbors.knn_graph(frame(spark, [1], np.eye(1)).limit(0), "id", "v").count() == 0


@pytest.mark.parametrize("odd", [[1.0, float("nan")], [float("inf"), 0.0], [1.0]])
def test_vectors_that_cannot_be_compared_are_refused(spark, odd):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, odd)], "id long, v array<double>")
    with pytest.raises(ValueError):
        neighbors.knn_graph(df, "id", "v")


def cells_of(spark, matrix, block_rows):
    vectors = frame(spark, range(len(matrix)), matrix).select("id", F.col("v").alias("vec"))
    return neighbors._Cells(vectors, len(matrix), matrix.shape[1], block_rows)


def test_strips_far_away_are_not_visited(spark):
    """Two far clusters: no probe crosses from one to the other."""
    rng = np.random.default_rng(3)
    matrix = np.concatenate([rng.normal(size=(100, 3)), rng.normal(size=(100, 3)) + 1000])
    probes, targets = neighbors.grid(cells_of(spark, matrix, 25), 5)
    seen, sent = {}, {}
    bounded = F.transform(F.filter(F.arrays_zip("ids", "radius"), lambda v: v["radius"] < math.inf), lambda v: v["ids"])
    for rows, held in ((targets, seen), (probes.withColumn("ids", bounded), sent)):
        for r in rows.select("band", "strip", "ids").collect():
            held.setdefault((r["band"], r["strip"]), set()).update(r["ids"])
    assert sent.keys() == seen.keys() and sum(map(len, sent.values())) > 200
    assert all({i < 100 for i in ids} <= {i < 100 for i in seen[where]} for where, ids in sent.items())


def test_copies_grow_with_the_root_of_the_blocks(spark):
    """Vectors without structure, where nothing can be skipped."""
    matrix = np.random.default_rng(4).normal(size=(1024, 48))
    for block_rows in (256, 64, 16):
        cells = cells_of(spark, matrix, block_rows)
        side = np.sqrt(cells.chunks.sum()) + 1
        for copies in neighbors.grid(cells, 7):
            sent = copies.agg(F.sum(F.octet_length("data"))).first()[0]
            assert sent <= 1024 * 48 * 8 * side, block_rows


def test_larger_tables_have_no_more_strips_than_their_bytes_need():
    pivots = np.random.default_rng(4).normal(size=(1024, 64))
    for blocks in (1, 10):  # of 64 vectors around each pivot
        _, width = neighbors._strips(pivots, np.full(1024, blocks), 64, 64)
        strips = math.ceil(1024 * blocks / width)
        assert strips <= max(10, math.ceil(1024 * blocks * 64 * 64 * 8 / 2**25))


def test_a_radius_within_the_sample_holds_enough_of_it():
    rng = np.random.default_rng(6)
    for scale, offset in ((1.0, 0.0), (1e-3, 100.0), (1e16, 0.0)):
        sample, m = rng.normal(size=(500, 8)) * scale + offset, rng.normal(size=(64, 8)) * scale + offset
        exact = np.sort(np.sqrt(((m[:, None] - sample[None]) ** 2).sum(-1)), axis=1)[:, 4]
        assert (neighbors._SampleRadius(sample)(m, 5) >= exact).all()
    assert np.isinf(neighbors._SampleRadius(sample[:5])(m, 5)).all()


def test_strips_give_few_neighbours_each(spark):
    """Far vectors of a strip are no neighbours to be ranked, though nothing is nearer there."""
    matrix = np.random.default_rng(5).normal(size=(3000, 24))
    cells = cells_of(spark, matrix, 32)
    probes, targets = neighbors.grid(cells, 5)
    found = neighbors._across(probes, targets, 5, 24, neighbors._Bounds(cells.pivots, cells.low, cells.high))
    strips = targets.select("strip").distinct().count()
    assert strips >= 9 and found.count() < 0.75 * 3000 * 5 * strips


@pytest.mark.parametrize("far", [0.0, 1e4, 1e17])
def test_rough_comparisons_lose_no_neighbour(far):
    """Vectors whose differences single precision does not hold."""
    rng = np.random.default_rng(6)
    matrix = rng.normal(size=(700, 8)) * (1 if far < 1e17 else 1e16) + far
    targets = pd.DataFrame({"cell": [0, 3], "chunk": [0, 0], "ids": [np.arange(300), np.arange(300, 700)]})
    targets["data"] = [matrix[ids].tobytes() for ids in targets["ids"]]
    away = np.zeros((700, 2))
    i, j, d = neighbors._Strip(targets, 8).nearest(np.arange(700), matrix, np.full(700, np.inf), away, 6)
    exact = np.linalg.norm(matrix[:, None] - matrix[None], axis=2)
    np.fill_diagonal(exact, np.inf)
    assert ({*zip(i.tolist(), j.tolist())} >= {(a, int(b)) for a in range(700) for b in np.argsort(exact[a])[:5]})


def test_ids_of_any_type(spark):
    rng = np.random.default_rng(7)
    matrix, ids = rng.normal(size=(60, 4)), rng.permutation(900)[:60]
    names = [f"id-{i}" for i in ids]
    vectors = frame(spark, ids, matrix).select(F.concat(F.lit("id-"), "id").alias("id"), "v")
    found = graph_of(neighbors.knn_graph(vectors, "id", "v", 5, block_rows=16))
    d = np.round(np.sqrt(((matrix[:, None] - matrix[None]) ** 2).sum(-1)), 6)
    for a, name in enumerate(names):
        assert [j for j, _ in found[name]] == [j for _, j in sorted((d[a, b], n) for b, n in enumerate(names) if b != a)[:5]]
    assert neighbors.knn_graph(vectors.limit(0), "id", "v").schema["j"].dataType.simpleString() == "string"


@pytest.mark.parametrize("kind", ["spread", "clustered", "copies"])
def test_descent_finds_nearly_all(spark, kind):
    rng = np.random.default_rng(8)
    matrix = rng.normal(size=(1500, 16))
    if kind == "clustered":
        matrix = np.repeat(rng.normal(size=(30, 16)) * 20, 50, axis=0) + matrix
    if kind == "copies":
        matrix[::3] = matrix[0]
    exact = brute_force(range(1500), matrix, 10)
    found = graph_of(neighbors.knn_descent(frame(spark, range(1500), matrix), "id", "v", 10, block_rows=100))
    assert all(len(near) == 10 and i not in {j for j, _ in near} for i, near in found.items()) and len(found) == 1500
    hits = sum(d <= exact[i][-1][1] + 1e-6 for i, near in found.items() for _, d in near)
    assert hits >= 0.9 * 15_000
    assert all(d == pytest.approx(np.linalg.norm(matrix[i] - matrix[j]), abs=2e-6) for i in range(0, 1500, 97) for j, d in found[i])


def test_descent_goes_on_until_it_finds_nearly_all(spark):
    """Vectors without structure, for which the first lists are too short."""
    matrix = np.random.default_rng(9).normal(size=(1200, 48))
    exact = brute_force(range(1200), matrix, 5)
    found = graph_of(neighbors.knn_descent(frame(spark, range(1200), matrix), "id", "v", 5, pool=6, block_rows=50))
    hits = sum(d <= exact[i][-1][1] + 1e-6 for i, near in found.items() for _, d in near)
    assert hits >= 0.9 * 6000


def test_fuzzy_weights(spark):
    rng = np.random.default_rng(4)
    matrix = rng.normal(size=(60, 5))
    vectors = frame(spark, range(60), matrix)
    edges = {(r["i"], r["j"]): r["w"] for r in neighbors.fuzzy_graph(vectors, "id", "v", 10).collect()}
    assert all(edges[j, i] == pytest.approx(w) and 0 < w <= 1 + 1e-12 for (i, j), w in edges.items())
    near = brute_force(range(60), matrix, 9)
    assert all(edges[i, n[0][0]] == pytest.approx(1.0) for i, n in near.items())
    directed = {}
    for r in neighbors.directed_weights(neighbors.knn_graph(vectors, "id", "v", 9), 10).collect():
        directed.setdefault(r["i"], []).append(r["w"])
    assert all(sum(w) == pytest.approx(np.log2(10), abs=1e-4) for w in directed.values())


def test_pca_matches_numpy(spark):
    rng = np.random.default_rng(5)
    matrix = rng.normal(size=(80, 4)) * [5, 3, 1, 0.5] + 10
    found = {r["id"]: (r["x"], r["y"]) for r in projection.pca_2d(frame(spark, range(80), matrix), "id", "v").collect()}
    centred = matrix - matrix.mean(0)
    axes = np.linalg.svd(centred, full_matrices=False)[2][:2].T
    axes *= np.sign(axes[np.abs(axes).argmax(0), [0, 1]])
    assert np.allclose([found[i] for i in range(80)], centred @ axes)


def test_curve_parameters_are_the_published_ones():
    a, b = projection.curve(0.1)
    assert (a, b) == (pytest.approx(1.577, abs=0.01), pytest.approx(0.895, abs=0.01))


def overlap(ids, matrix, points, k=15):
    before, after = brute_force(ids, matrix, k), brute_force(ids, points, k)
    return np.mean([len({j for j, _ in before[i]} & {j for j, _ in after[i]}) / k for i in ids])


def test_layout_keeps_neighbours_better_than_pca_and_repeats(spark):
    rng = np.random.default_rng(6)
    matrix = np.repeat(rng.normal(size=(8, 10)) * 3, 25, axis=0) + rng.normal(size=(200, 10))
    vectors = frame(spark, range(200), matrix)

    def points(df):
        found = {r["id"]: (r["x"], r["y"]) for r in df.collect()}
        return np.array([found[i] for i in range(200)])

    layout = points(projection.layout_2d(vectors, "id", "v", epochs=12))
    again = points(projection.layout_2d(vectors.repartition(3), "id", "v", epochs=12))
    assert (layout == again).all()
    assert overlap(range(200), matrix, layout) > overlap(range(200), matrix, points(projection.pca_2d(vectors, "id", "v")))


def test_edges_stay_where_their_far_ends_are(spark, monkeypatch):
    """An epoch shuffles positions and moves, but not the edges, and a hub's parts give what the hub gives."""
    n = 200
    star = [(0, j, 0.5) for j in range(1, n)] + [(j, 0, 0.5) for j in range(1, n)]
    graph = spark.createDataFrame(star, "i long, j long, w double")
    at = spark.range(n).select(F.col("id").alias("v"), F.sin("id").alias("x"), F.cos("id").alias("y"))
    whole = projection.layout_step(at, graph, 2).orderBy("v").collect()
    monkeypatch.setattr(projection, "EDGES_PER_PART", 10)
    assert projection.layout_step(at, graph, 2).orderBy("v").collect() == whole

    edges, parts = projection._split_edges(graph)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        placed = projection.checkpointed(projection._placed(at, parts))
        dealt = projection._dealt(edges)
        step = projection._stepped(placed, dealt, n, 200, 42, projection._forces(*projection.curve(0.1)))
        plan = step._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Between the edges and their join there is a sort, and no exchange.
    near_join = plan[plan.index("SortMergeJoin [vj") : plan.index("InMemoryTableScan [vi")]
    assert "Exchange" not in near_join and plan.count("ENSURE_REQUIREMENTS") >= 4


def test_hubs_are_cut_into_parts(spark, monkeypatch):
    monkeypatch.setattr(projection, "EDGES_PER_PART", 10)
    star = [(0, j, 1.0) for j in range(1, 101)] + [(j, 0, 1.0) for j in range(1, 101)]
    edges, parts = projection._split_edges(spark.createDataFrame(star, "i long, j long, w double"))
    assert {r["v"]: r["parts"] for r in parts.collect()}[0] == 10
    assert edges.count() == 200
    assert edges.groupBy("vi", "pi").count().agg({"count": "max"}).first()[0] < 30
    assert edges.groupBy("vj", "pj").count().agg({"count": "max"}).first()[0] < 30


def test_registered_layout_runs_all_epochs(spark, sf, monkeypatch):
    run, given = inspect.signature(projection.layout_2d), {}

    def layout(*args, **options):
        bound = run.bind(*args, **options)
        bound.apply_defaults()
        given.update(bound.arguments)
        return projection.pca_2d(*args[:3])

    monkeypatch.setattr(projection, "layout_2d", layout)
    assert QUERIES["layout_2d"](spark, sf).count() == 500 and given["epochs"] == 200


def test_size_of_the_layout_does_not_grow_with_its_epochs(spark):
    """Epochs took two to three times as long as those before: sizes of joins are products of those of their sides."""
    ring = [(i, (i + k) % 50, 0.5) for i in range(50) for k in (1, 49)]
    edges, parts = projection._split_edges(spark.createDataFrame(ring, "i long, j long, w double"))
    at = spark.range(50).select(F.col("id").alias("v"), F.sin("id").alias("x"), F.cos("id").alias("y"))
    at = projection._moved(projection._placed(at, parts), edges, 50, 200, 42, projection._forces(*projection.curve(0.1)), 3)
    assert [r["epoch"] for r in at.select("epoch").distinct().collect()] == [3] and at.count() == 50
    size = at._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    assert size < 1_000_000
