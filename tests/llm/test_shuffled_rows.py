"""Operators that scan their rows more than once, on rows that a shuffle may deal otherwise each time."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusflow.llm import bpe, imatch, language_model, quality, token_counts

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))


@pytest.fixture(params=["dropDuplicates", "groupBy", "repartition"])
def shuffled(request, spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    if request.param == "dropDuplicates":
        yield docs.dropDuplicates(["doc_id"])
    elif request.param == "groupBy":
        yield docs.groupBy("doc_id").agg(F.first("text").alias("text"))
    else:
        yield docs.repartition("doc_id")
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_counts_are_the_library_s(shuffled):
    model = Tokenizer.from_file(BYTE)
    texts = {r["doc_id"]: r["text"] for r in shuffled.collect()}
    found = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(shuffled, BYTE).collect()}
    assert found == {d: len(model.encode(t).ids) for d, t in texts.items()}


def test_ids_are_the_library_s(shuffled):
    model = Tokenizer.from_file(WORD)
    texts = {r["doc_id"]: r["text"] for r in shuffled.collect()}
    found = {r["doc_id"]: r["ids"] for r in bpe.encode_decode(shuffled, WORD).collect()}
    assert found == {d: model.encode(t, add_special_tokens=False).ids for d, t in texts.items()}


def test_scores_do_not_depend_on_the_dealing(spark, shuffled):
    plain = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    learn = F.col("doc_id") % 7 != 2
    expected, found = (
        {r["doc_id"]: r["score"] for r in language_model.train_and_score(d, learn)[1].collect()} for d in (plain, shuffled)
    )
    assert found == pytest.approx(expected)


@pytest.mark.parametrize("kind", ["tinyint", "smallint", "int"])
def test_small_ids(spark, kind):
    docs = spark.createDataFrame([(i, f"some words of text {i}") for i in range(5)], f"doc_id {kind}, text string")
    assert imatch.fingerprints(docs).schema["doc_id"].dataType.simpleString() == kind
    assert sorted(r["doc_id"] for r in imatch.fingerprints(docs).collect()) == list(range(5))
    assert quality.classify(docs).count() == 5


def test_one_id_for_all_rows(spark):
    docs = spark.createDataFrame([(7, f"some words of text {i}") for i in range(100)], "doc_id long, text string")
    found = quality.classify(docs, train_rows=10).collect()
    assert len(found) == 100 and all(0 <= r["score"] <= 1 for r in found)
