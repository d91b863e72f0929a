"""Queries of the operators in this package, with their production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusflow.llm import (
    bpe, fill_middle, imatch, language_model, line_dedup, line_rules, merkle, minhash, mixing, quality, secrets, simhash,
    token_counts,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def registered(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@registered
def op1_token_counts(spark, sf_dir):
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), stable=True)


@registered
def op8_bpe(spark, sf_dir):
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.encode_decode(_table(spark, sf_dir, "documents"), path, bpe.DIGESTS, stable=True)


@registered
def op6_language_model(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    learn = F.coalesce(F.crc32(F.col("doc_id").cast("string")), F.lit(0)) % 7 != 2
    return language_model.train_and_score(docs, learn, stable=True)[1]


@registered
def op10_simhash(spark, sf_dir):
    return simhash.near_duplicates(_table(spark, sf_dir, "documents")).drop("text_key", "root")


@registered
def op3_quality(spark, sf_dir):
    return quality.classify(_table(spark, sf_dir, "documents"))


@registered
def op4_imatch(spark, sf_dir):
    return imatch.fingerprints(_table(spark, sf_dir, "documents"))


@registered
def op5_line_rules(spark, sf_dir):
    judged = line_rules.judge(_table(spark, sf_dir, "documents"))
    return judged.drop("host", "text_key", "removed")


@registered
def op2_mixing(spark, sf_dir):
    return mixing.positions(_table(spark, sf_dir, "documents"))


ORACLES["op2_mixing"] = mixing.ORACLE


@registered
def op9_secrets(spark, sf_dir):
    return secrets.find_secrets(_table(spark, sf_dir, "documents"))


@registered
def op7_line_dedup(spark, sf_dir):
    return line_dedup.report(_table(spark, sf_dir, "documents"))


ORACLES["op7_line_dedup"] = line_dedup.ORACLE


@registered
def op11_fill_middle(spark, sf_dir):
    return fill_middle.report(_table(spark, sf_dir, "documents"))


ORACLES["op11_fill_middle"] = fill_middle.ORACLE


@registered
def op12_minhash(spark, sf_dir):
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


ORACLES["op12_minhash"] = minhash.ORACLE


@registered
def op13_merkle(spark, sf_dir):
    return merkle.report(_table(spark, sf_dir, "documents"))


ORACLES["op13_merkle"] = merkle.ORACLE
