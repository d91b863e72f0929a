import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusflow.functions import vectors as V
from corpusflow.operators import encode


def by_hand(text, dim=16):
    total = np.zeros(dim)
    for token in text.split():
        total += [2 * b - 255 for b in hashlib.md5(token.encode()).digest()[:dim]]
    norm = np.linalg.norm(total)
    return total / norm if norm else total


class Picky:
    """Fails on any batch that holds the word ``bad``."""

    def __call__(self):
        def run(texts):
            if any("bad" in t for t in texts):
                raise ValueError("bad text")
            return np.ones((len(texts), 2))

        return run


TEXTS = ["one two", "two  one\n", "", "längere Sätze mit Wörtern", "a " * 500, "x"]


def test_token_hash_matches_the_definition():
    found = encode.TokenHashEncoder()(TEXTS)
    assert np.allclose(found, [by_hand(t) for t in TEXTS])
    assert np.allclose(encode.TokenHashEncoder(dim=4, max_tokens=2)(["a b c"])[0], by_hand("a b", 4))


def test_vocabulary_is_bounded(monkeypatch):
    monkeypatch.setattr(encode, "_VOCABULARY_LIMIT", 10)
    encoder = encode.TokenHashEncoder()
    for start in range(0, 100, 5):
        text = " ".join(f"t{i}" for i in range(start, start + 5))
        assert np.allclose(encoder([text])[0], by_hand(text))
    assert len(encoder._rows) <= 20


@pytest.mark.parametrize(("partitions", "batch"), [(1, 1), (7, 2), (64, 32)])
def test_vectors_do_not_depend_on_batches(spark, partitions, batch):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string").repartition(partitions)
    found = {r["id"]: r["embeddings"] for r in encode.embed(df, "text", batch_size=batch).collect()}
    assert found == {i: pytest.approx(by_hand(t).tolist()) for i, t in enumerate(TEXTS)}


def test_prefix_and_null_texts(spark):
    df = spark.createDataFrame([(1, "hello"), (2, None)], "id long, text string")
    (row,) = encode.embed(df, "text", prefix="query: ", keep=["id", "text"]).collect()
    assert row["text"] == "hello" and np.allclose(row["embeddings"], by_hand("query: hello"))


def test_one_bad_text_does_not_take_the_batch_with_it(spark):
    df = spark.createDataFrame([(i, "bad" if i == 3 else "good") for i in range(8)], "id long, text string")
    rows = {r["id"]: r for r in encode.embed(df.coalesce(1), "text", Picky()).collect()}
    assert rows[3]["embeddings"] is None and rows[3]["error"] == "bad text"
    assert all(rows[i]["embeddings"] == [1.0, 1.0] and rows[i]["error"] is None for i in range(8) if i != 3)


class Odd:
    """Gives too few vectors, too wide ones or numbers that are not finite, by words of the text."""

    dim = 2

    def __call__(self):
        def run(texts):
            rows = [[np.nan, 0.0] if "nan" in t else [1.0, 2.0] for t in texts]
            if any("wide" in t for t in texts):
                rows = [[*r, 3.0] for r in rows]
            return np.array(rows[:-1] if any("short" in t for t in texts) else rows)

        return run


def test_results_that_break_the_contract_are_errors(spark):
    texts = ["good", "short", "wide", "nan", "good too", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").coalesce(1)
    for batch in (1, 4, 32):
        rows = {r["id"]: r for r in encode.embed(df, "text", Odd(), batch_size=batch).collect()}
        assert [rows[i]["embeddings"] for i in range(6)] == [[1.0, 2.0], None, None, None, [1.0, 2.0], [1.0, 2.0]]
        assert [rows[i]["error"] is None for i in range(6)] == [True, False, False, False, True, True]
    told = encode.embed(df, "text", Picky(), width=3).collect()
    assert all(r["embeddings"] is None and "3 expected" in r["error"] for r in told)


def test_floats_take_half_the_bytes(spark, tmp_path):
    df = spark.range(2000).select("id", F.concat(F.lit("text "), "id").alias("text")).coalesce(1)
    sizes = {}
    for numbers in ("double", "float"):
        out = str(tmp_path / numbers)
        encode.embed(df, "text", numbers=numbers).select("embeddings").write.option("compression", "none").option(
            "parquet.enable.dictionary", "false"
        ).parquet(out)
        sizes[numbers] = sum(f.stat().st_size for f in (tmp_path / numbers).glob("*.parquet"))
        assert spark.read.parquet(out).schema["embeddings"].dataType.elementType.simpleString() == numbers
    assert sizes["float"] < 0.6 * sizes["double"]


def test_masked_mean_ignores_padding():
    states = np.array([[[1.0, 2.0], [3.0, 4.0], [100.0, 100.0]]])
    assert encode.masked_mean(states, np.array([[1, 1, 0]])).tolist() == [[2.0, 3.0]]
    assert encode.unit_rows(np.array([[3.0, 4.0], [0.0, 0.0]])).tolist() == [[0.6, 0.8], [0.0, 0.0]]


def test_token_columns(spark):
    row = spark.createDataFrame([("a  b\nc",)], "t string").select(
        encode.token_count(F.col("t")).alias("n"),
        encode.token_count(F.col("t"), 2).alias("cut"),
        encode.truncated(F.split("t", r"\s+"), 2).alias("first"),
        encode.prefixed(F.col("t"), "p: ").alias("p"),
    ).first()
    assert (row["n"], row["cut"], row["first"], row["p"]) == (3, 2, ["a", "b"], "p: a  b\nc")


def test_vector_columns(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame(
        [(1, [3.0, 4.0]), (2, [0.0, 0.0]), (3, [nan, inf, -inf, nan])], "id int, v array<double>"
    )
    v = F.col("v")
    s = V.stats(v)
    rows = {
        r["id"]: r
        for r in df.select(
            "id",
            V.l2_normalised(v).alias("u"),
            V.nan_count(v).alias("nan"),
            V.inf_count(v).alias("inf"),
            *[s[name].alias(name) for name in ("std", "mean", "norm")],
        ).collect()
    }
    assert rows[1]["u"] == [0.6, 0.8] and (rows[1]["mean"], rows[1]["std"], rows[1]["norm"]) == (3.5, 0.5, 5.0)
    assert rows[2]["u"] == [0.0, 0.0]
    assert (rows[3]["nan"], rows[3]["inf"]) == (2, 2) and (rows[1]["nan"], rows[1]["inf"]) == (0, 0)
    pooled = spark.range(1).select(V.mean_of(F.expr("array(array(1D, 2D), array(3D, 6D))")).alias("m")).first()
    assert pooled["m"] == [2.0, 4.0]


def test_long_batches_are_encoded_in_pieces(spark):
    batch = pa.RecordBatch.from_pydict({"n": list(range(2500))})
    pieces = list(encode._pieces(iter([batch, batch.slice(0, 10)])))
    assert [(p.num_rows, later) for p, later in pieces] == [(1024, False), (1024, True), (452, True), (10, False)]
    rows = spark.range(2500, numPartitions=1).select("id", F.concat(F.lit("a "), F.col("id").cast("string")).alias("text"))
    found = {r["id"]: r["embeddings"] for r in encode.embed(rows, "text", keep=["id"]).collect()}
    assert len(found) == 2500 and np.allclose(found[2400], by_hand("a 2400"))
