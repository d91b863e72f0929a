"""The stages of the pipeline on the smallest tables, each on what the one before kept."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from corpusflow.llm import line_rules, mixing, simhash
from corpusflow.session import fresh_path, stored
from llm.test_operators import brute_fingerprint, components
from tools.compare import connect, differences


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs = stored(spark.read.parquet(f"{sf}/documents.parquet"))
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], sf), name))
    return out


def test_stages_keep_the_columns_and_follow_each_other(stages):
    raw, ruled, lines, single, mixed, encoded = stages
    assert all(s.columns == raw.columns for s in stages[:-1])
    kept = {r["doc_id"] for r in line_rules.judge(raw).filter("kept").collect()}
    assert {r["doc_id"] for r in ruled.collect()} == kept == {r["doc_id"] for r in lines.collect()}
    rows = sorted((r["doc_id"], r["text"]) for r in lines.collect())
    labels = components([brute_fingerprint(t) for _, t in rows])
    assert {r["doc_id"] for r in single.collect()} == {rows[c][0] for c in labels}
    assert sorted(map(tuple, mixed.collect())) == sorted(map(tuple, single.collect()))
    assert encoded.count() == mixed.count()


def test_mixture_is_in_order(spark, stages):
    _, _, _, single, mixed, encoded = stages
    place = {r["row"]["doc_id"]: (r["slot"], r["place"]) for r in mixing.mix(single).collect()}
    rows = sorted((r["position"], r["doc_id"]) for r in encoded.collect())
    assert [p for p, _ in rows] == list(range(len(place)))
    order = [place[d] for _, d in rows]
    assert order == sorted(order) and len({d for _, d in rows}) == len(place)


def test_positions_are_those_of_the_written_rows(spark):
    split = spark.newSession()
    split.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 512).alias("text"))
    path = fresh_path(spark, "sorted")
    docs.orderBy(F.xxhash64("doc_id")).write.option("maxRecordsPerFile", 300).parquet(path)
    order = [r["doc_id"] for r in docs.orderBy(F.xxhash64("doc_id")).collect()]
    written = split.read.parquet(path)
    assert len(written.inputFiles()) > 8
    placed, files = mixing.written_places(written, ["doc_id"])
    found = placed.join(files, "file").select((F.col("before") + F.col("at")).alias("p"), "doc_id")
    assert sorted(map(tuple, found.collect())) == list(enumerate(order))


def test_tokens_are_the_library_s(stages):
    model = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    model.no_truncation()
    model.no_padding()
    texts = {r["doc_id"]: r["text"] or "" for r in stages[-2].collect()}
    for r in stages[-1].collect():
        assert list(r["ids"]) == model.encode(texts[r["doc_id"]], add_special_tokens=False).ids and r["n_tokens"] == len(r["ids"])


def test_pipeline_is_its_stages(spark, sf, stages):
    assert sorted(map(tuple, queries()["pipeline"](spark, sf).collect())) == sorted(map(tuple, stages[-1].collect()))


def test_stage_of_near_duplicates_broadcasts_no_exploded_rows(spark, sf, stages, monkeypatch):
    """Rows that were exploded after the last exchange are many more than Spark takes them to be."""

    def below_broadcasts(plan):
        lines, found = plan.split("== Initial Plan ==")[0].splitlines(), []
        depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
        for i, line in enumerate(lines):
            if "BroadcastExchange" in line:
                for d, other in zip(depth[i + 1 :], lines[i + 1 :]):
                    if d <= depth[i] or " Exchange " in other:
                        break
                    found.append(other)
        return found

    plans = []

    def ran(df):
        df.collect()
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(simhash, "stored", lambda df, name: stored(ran(df), name))
    ran(corpus_pipeline.dedup_documents(spark, stages[2], sf))
    assert any("Generate" in plan for plan in plans)
    assert not any("Generate" in line for plan in plans for line in below_broadcasts(plan))


@pytest.mark.parametrize("name", ["op2_mixing", "op7_line_dedup"])
def test_queries_with_sql(spark, sf, name):
    with connect(sf) as con:
        assert differences(queries()[name](spark, sf).toPandas(), con.execute(oracle_sql()[name]).df()) is None


def test_there_is_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries() if n.startswith("op")) == list(range(1, 14))
