"""A corpus from raw documents to token ids, one stage after the other.

Each stage reads what the one before wrote. All but the last return the columns of documents.
"""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusflow.llm import bpe, line_dedup, line_rules, mixing, simhash
from corpusflow.session import ship, stored

TOKENIZER = "word_bpe_49k.json"


def _shipped(spark: SparkSession) -> None:
    ship(spark, Path(__file__).resolve().parent, ["corpusflow", "checks"])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go, and the lines over the limit of their host from the others."""
    _shipped(spark)
    return line_rules.clean(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that equal or nearly equal an earlier one go; all documents stay."""
    _shipped(spark)
    return line_dedup.without_lines(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the least id."""
    _shipped(spark)
    return simhash.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the order of the mixture, which the written files keep and ``encode`` reads as positions."""
    _shipped(spark)
    return mixing.mixture(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, digests of them and of the decoded text, and its ``position``.

    Positions count from 0 in the order in which the stage before wrote the documents: sorted by them,
    the rows are the mixture. ``docs`` must be read from its Parquet files.
    """
    _shipped(spark)
    placed, files = mixing.written_places(docs, ["doc_id", "text"])
    results = ["ids", *bpe.DIGESTS]
    path = public_tokenizers.path(TOKENIZER)
    encoded = bpe.encode_decode(placed, path, results, stable=True, keep=["file", "at"])
    position = (F.col("before") + F.col("at")).alias("position")
    return encoded.join(files, "file").select("doc_id", position, "n_tokens", *results)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", dedup_lines),
    ("simhash_dedup", dedup_documents),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: Fingerprints, components and byte-pair merges are not for SQL: the tests hold brute force against them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
