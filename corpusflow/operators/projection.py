"""Two-dimensional layouts of embedding sets."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from corpusflow.operators import ordering
from corpusflow.operators.neighbors import fuzzy_graph
from corpusflow.operators.provenance import TEXT_CHARS
from corpusflow.session import checkpointed, fresh_path, stored

# Fixed values of the layout: weight of repulsion, random partners per vertex and epoch,
# longest step of one force, extent of the first positions.
REPULSION = 5.0
PARTNERS = 5
MAX_FORCE = 4.0
EXTENT = 10.0

#: Part of a force that sums are exact to, and the golden ratio of the draws.
UNIT = 4294967296
GOLDEN = 0.6180339887498949

EDGES_PER_PART = 10_000


def pca_2d(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(id, x, y)``: first two principal components of the centred vectors.

    The covariance is summed on the executors; only a dim × dim matrix reaches the driver.
    The largest loading of each component is made positive, which fixes its sign.
    """
    rows = vectors.select(F.col(id_col), F.col(vector_col).cast("array<double>").alias("_v"))
    rows = rows.filter(F.col("_v").isNotNull()).select(id_col, array_to_vector("_v").alias("_f"))
    mean = rows.select(Summarizer.mean(F.col("_f")).alias("m")).first()["m"].toArray()
    model = PCA(k=min(2, len(mean)), inputCol="_f", outputCol="_p").fit(rows)
    loadings = model.pc.toArray()
    signs = np.sign(loadings[np.abs(loadings).argmax(axis=0), np.arange(loadings.shape[1])])
    shift = mean @ loadings
    projected = model.transform(rows)
    at = vector_to_array("_p")

    def component(i: int) -> Column:
        if i >= len(signs):
            return F.lit(0.0)
        return (F.get(at, F.lit(i)) - float(shift[i])) * float(signs[i])

    return projected.select(id_col, component(0).alias("x"), component(1).alias("y"))


def curve(min_dist: float, spread: float = 1.0) -> tuple[float, float]:
    """``a, b`` for which 1 / (1 + a d^2b) follows the wanted fall-off of similarity.

    Least squares by Gauss-Newton on 300 points, the same for any data.
    """
    d = np.linspace(1e-3, 3 * spread, 300)
    wanted = np.where(d < min_dist, 1.0, np.exp(-(d - min_dist) / spread))
    p = np.array([1.0, 1.0])
    for _ in range(200):
        powered = d ** (2 * p[1])
        fit = 1.0 / (1.0 + p[0] * powered)
        slopes = np.stack([-powered * fit**2, -p[0] * powered * 2 * np.log(d) * fit**2], axis=1)
        step = np.linalg.lstsq(slopes, wanted - fit, rcond=None)[0]
        p = np.maximum(p + 0.5 * step, 1e-3)
    return float(p[0]), float(p[1])


def _clipped(x: str) -> str:
    return f"greatest(-{MAX_FORCE}D, least({MAX_FORCE}D, {x}))"


def _forces(a: float, b: float) -> tuple[str, str]:
    """Pull along an edge of weight ``w`` and push between random partners, as SQL.

    Forces are whole multiples of ``2 ** -32``: their sums do not depend on the order of the rows.
    """
    d2 = "((x - xj) * (x - xj) + (y - yj) * (y - yj))"
    fall = f"(1 + {a}D * pow({d2}, {b}D))"
    pull = f"if({d2} > 0, {-2 * a * b}D * pow({d2}, {b - 1}D) / {fall}, 0D)"
    push = f"{2 * b}D / ((0.001D + {d2}) * {fall})"
    strength = f"if(push, degree * {REPULSION / PARTNERS}D * {push}, w * {pull})"
    forces = (_clipped(f"{strength} * ({c} - {c}j)") for c in "xy")
    return tuple(f"cast(round({force} * {UNIT}D) AS long)" for force in forces)


def layout_2d(
    vectors: DataFrame,
    id_col: str,
    vector_col: str,
    n_neighbors: int = 15,
    min_dist: float = 0.1,
    epochs: int = 200,
    seed: int = 42,
    block_rows: int | None = None,
) -> DataFrame:
    """``(id, x, y)``: neighbours pulled together, random partners pushed apart.

    Starts from the principal components. Each epoch is a join of the edge table with the
    positions of both ends, summed per vertex; vertices with very many edges are cut into
    parts. Partners follow from seed and epoch and forces are summed exactly, so a run repeats
    to the last digit, however the rows are dealt.
    """
    a, b = curve(min_dist)
    numbered = stored(_numbered(vectors, id_col, vector_col), "layout-vectors")
    n = numbered.count()
    graph = fuzzy_graph(numbered, "v", "vec", n_neighbors, block_rows)
    edges, parts = _split_edges(stored(graph, "layout-graph"))
    start = stored(pca_2d(numbered, "v", "vec"), "layout-start")
    extent = start.agg(F.greatest(F.max(F.abs("x")), F.max(F.abs("y")), F.lit(1e-12)).alias("m")).first()["m"]
    scale = EXTENT / extent
    scaled = start.select("v", (F.col("x") * scale).alias("x"), (F.col("y") * scale).alias("y"))
    at = _moved(_placed(scaled, parts), edges, n, epochs, seed, _forces(a, b), epochs)
    return numbered.join(at, "v").select(F.col("id").alias(id_col), "x", "y")


def layout_step(
    positions: DataFrame,
    graph: DataFrame,
    epoch: int,
    epochs: int = 200,
    min_dist: float = 0.1,
    seed: int = 42,
) -> DataFrame:
    """``(v, x, y)`` one epoch after ``positions(v, x, y)``, vertices being numbered from 0 without gaps.

    ``graph(i, j, w)`` has both directions of each edge.
    """
    edges, parts = _split_edges(graph)
    at = _placed(positions.select("v", "x", "y"), parts).withColumn("epoch", F.lit(epoch))
    n = positions.count()
    return _moved(stored(at, "layout"), edges, n, epochs, seed, _forces(*curve(min_dist)), 1).select("v", "x", "y")


def _placed(positions: DataFrame, parts: DataFrame) -> DataFrame:
    """Positions before the first epoch, with degree and number of parts."""
    return positions.join(parts, "v", "left").select(
        "v", "x", "y", F.coalesce("degree", F.lit(0.0)).alias("degree"), F.coalesce("parts", F.lit(1)).alias("parts"),
        F.lit(0).alias("epoch"),
    )


def _numbered(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Vectors with dense numbers ``v`` in id order."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vec"))
    rows = rows.filter(F.col("vec").isNotNull())
    numbers = ordering.positions(rows.select("id"), [], ["id"], "v")
    return rows.join(numbers, "id")


def _split_edges(graph: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges whose two ends carry a part number, and degree and number of parts per vertex.

    A vertex with many edges is cut into parts of about ``EDGES_PER_PART``, so that the joins
    with the positions have no hot key.
    """
    parts = stored(
        graph.groupBy(F.col("i").alias("v")).agg(
            F.sum("w").alias("degree"),
            F.ceil(F.count(F.lit(1)) / EDGES_PER_PART).cast("int").alias("parts"),
        ),
        "layout-degrees",
    )
    many = parts.filter(F.col("parts") > 1).select("v", "parts")
    cut = graph
    for end, other in (("i", "j"), ("j", "i")):
        named = many.select(F.col("v").alias(end), F.col("parts").alias("_parts"))
        part = F.pmod(F.xxhash64(other), F.coalesce("_parts", F.lit(1))).cast("int")
        cut = cut.join(named, end, "left").withColumn(f"p{end}", part).drop("_parts")
    return stored(cut.select(F.col("i").alias("vi"), "pi", F.col("j").alias("vj"), "pj", "w"), "layout-edges"), parts


def _moved(
    at: DataFrame, edges: DataFrame, n: int, epochs: int, seed: int, forces: tuple[str, str], turns: int
) -> DataFrame:
    """Positions after ``turns`` more epochs.

    Edges stay where their far ends are, split over as many partitions as a shuffle has, so only
    positions move: to the edges that start there, and along them to the vertices they pull. An
    epoch uses the positions three times, so each one is checkpointed: a plan of several epochs
    would grow threefold with each. Positions take turns in two folders.
    """
    folders = [fresh_path(at.sparkSession, "layout-positions") for _ in range(2)]
    dealt, at = _dealt(edges), checkpointed(at, folders[0])
    for turn in range(1, turns + 1):
        at = checkpointed(_stepped(at, dealt, n, epochs, seed, forces), folders[turn % 2])
    dealt.unpersist()
    return at


def _dealt(edges: DataFrame) -> DataFrame:
    """The stored edges by their far ends, kept on the executors; a lost part is dealt again."""
    width = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = edges.repartition(width, "vj", "pj").persist(StorageLevel.MEMORY_AND_DISK)
    dealt.count()  # later plans know the partitioning of what is there
    return dealt


def _stepped(at: DataFrame, edges: DataFrame, n: int, epochs: int, seed: int, forces: tuple[str, str]) -> DataFrame:
    """Positions after one more epoch.

    The epoch is a column, not a literal, so that every epoch runs the same compiled code. In
    each of an epoch's draws every vertex pushes the one that many numbers below it; the steps of
    the golden ratio spread the draws evenly over all distances.
    """
    draw = f"({seed + 1}D + epoch * {PARTNERS}D + s) * {GOLDEN}D"
    shift = f"cast(1 + floor({n - 1}D * ({draw} - floor({draw}))) AS long)"
    pushes = (
        at.selectExpr("v", "x", "y", "epoch", f"explode(sequence(0, {PARTNERS - 1})) AS s")
        .selectExpr(f"pmod(v - {shift}, {n}L) AS vi", "0 AS pi", "x AS xj", "y AS yj", "0D AS w", "true AS push", "v AS vj")
        .filter("vi <> vj")
        .drop("vj")
    )
    each = at.selectExpr("v", "x", "y", "degree", "explode(sequence(0, parts - 1)) AS p")
    far = each.selectExpr("v AS vj", "p AS pj", "x AS xj", "y AS yj")
    near = each.selectExpr("v AS vi", "p AS pi", "x", "y", "degree")
    pulls = edges.join(far, ["vj", "pj"]).select("vi", "pi", "xj", "yj", "w", F.lit(False).alias("push"))
    fx, fy = forces
    state = ["x", "y", "degree", "parts", "epoch"]
    moves = pulls.unionByName(pushes).join(near, ["vi", "pi"]).selectExpr("vi AS v", f"{fx} AS fx", f"{fy} AS fy")
    own = at.selectExpr("v", *state, "0L AS fx", "0L AS fy")
    summed = own.unionByName(moves, allowMissingColumns=True).groupBy("v").agg(
        F.sum("fx").alias("fx"), F.sum("fy").alias("fy"), *[F.max(c).alias(c) for c in state]
    )
    step = f"(1 - epoch / {float(epochs)}D) * {{}}"
    return summed.selectExpr(
        "v",
        f"x + {step.format(_clipped(f'(fx / {UNIT}D)'))} AS x",
        f"y + {step.format(_clipped(f'(fy / {UNIT}D)'))} AS y",
        "degree",
        "parts",
        "epoch + 1 AS epoch",
    )


def point_table(positions: DataFrame, sources: DataFrame, on: Sequence[str]) -> DataFrame:
    """Plot points ``x, y, split, dataset, text``, text cut."""
    described = sources.select(*on, "split", "dataset", F.substring("text", 1, TEXT_CHARS).alias("text"))
    return positions.join(described, list(on), "inner").select(*on, "x", "y", "split", "dataset", "text")
