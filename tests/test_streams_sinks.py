import json

import pytest
from pyspark.sql import functions as F

from checks import inputs
from corpusflow.operators import encode, runlog, shards
from corpusflow.plans import layout_run
from corpusflow.plans.projection_run import points_of_json
from corpusflow.sources import large_json, samples as sources, writers
from corpusflow.streaming import jobs


def rows_of(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_restart_embeds_only_new_files(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    docs.filter("doc_id < 100").repartition(2).write.parquet(source)

    def run():
        stream = jobs.file_stream(spark, source, docs.schema, files_per_batch=1)
        jobs.run(lambda: jobs.embed_new_files(stream, out, state, ["doc_id"]))
        return spark.read.parquet(out)

    assert run().count() == 100
    assert run().count() == 100
    docs.filter("doc_id >= 100").write.mode("append").parquet(source)
    found = run()
    assert rows_of(found) == rows_of(encode.embed(docs, "text", keep=["doc_id"]))


def test_streamed_totals_and_states_equal_the_batch(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet")
    source = str(tmp_path / "in")
    events.repartition(3).write.parquet(source)
    log = inputs.as_run_log(events)

    def streamed(job, name):
        stream = inputs.as_run_log(jobs.file_stream(spark, source, events.schema, files_per_batch=1))
        out = str(tmp_path / name)
        jobs.run(lambda: job(stream, out, out + "-state"))
        return jobs.latest_batch(spark, out)

    assert rows_of(streamed(jobs.stream_totals, "totals")) == rows_of(runlog.totals_by_status(log))
    assert rows_of(streamed(jobs.stream_latest, "latest")) == rows_of(runlog.latest(log))


def test_tables_of_a_stream_do_not_grow_with_its_batches(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet")
    source, out = tmp_path / "in", tmp_path / "out"
    events.filter("event_id < 600").repartition(12).write.parquet(str(source))

    def run():
        stream = inputs.as_run_log(jobs.file_stream(spark, str(source), events.schema, files_per_batch=1))
        jobs.run(lambda: jobs.stream_latest(stream, str(out), str(tmp_path / "state")))
        return {p.name for p in out.iterdir()}, len(list(out.rglob("*.parquet")))

    assert run() == ({"slot=0", "slot=1"}, 2)
    events.filter("event_id >= 600").repartition(9).write.mode("append").parquet(str(source))
    assert run() == ({"slot=0", "slot=1"}, 2)
    found = spark.read.parquet(str(out))
    assert found.agg(F.max("batch")).first()[0] == 20
    assert rows_of(jobs.latest_batch(spark, str(out))) == rows_of(runlog.latest(inputs.as_run_log(events)))

    # A batch that was cut off while it wrote is repeated from the table before it.
    log = runlog.latest(inputs.as_run_log(events))
    again = jobs._merged(spark, log.limit(0), "worker", str(out), 21)
    assert rows_of(again) == rows_of(log)


def test_rewriting_a_shard_leaves_the_others(spark, tmp_path):
    schema = "dataset string, split string, shard_id int, embeddings array<double>, original_index long"
    root = str(tmp_path / "e")
    first = [("d", "s", k, [float(k)], i) for k in (0, 1) for i in range(5)]
    writers.write_embeddings(spark.createDataFrame(first, schema), root, rows_per_file=2)
    writers.write_embeddings(spark.createDataFrame([("d", "s", 1, [9.0], 0)], schema), root)
    stored = sources.read_shards(spark, root)
    assert {(r["shard_id"], r["n"]) for r in stored.groupBy("shard_id").agg(F.count("*").alias("n")).collect()} == {(0, 5), (1, 1)}
    assert shards.skipped(spark.createDataFrame(first, schema), stored.distinct()).count() == 10
    files = {p.parent.name for p in (tmp_path / "e").rglob("*.parquet")}
    assert files == {"shard_id=0", "shard_id=1"}


def test_samples_by_folder(spark, tmp_path):
    root = str(tmp_path / "samples")
    df = spark.createDataFrame([("d", "chat", "a"), ("d", "math", "b")], "dataset string, split string, text string")
    df.write.partitionBy("dataset", "split").json(root)
    schema = df.select("text").schema
    assert sources.read_samples(spark, root, schema, "json").count() == 2
    one = sources.read_samples(spark, root, schema, "json", split="math")
    assert [tuple(r) for r in one.collect()] == [("b", "d", "math")]
    assert sources.list_files(spark, root, "*.json").count() == 2


@pytest.mark.parametrize("multi_line", [True, False])
def test_embedding_json(spark, tmp_path, multi_line):
    items = [
        {"embedding": [1.0, 2.0], "split": "s", "text": "é" * 120, "dataset": "d"},
        {"embedding": None, "split": "s", "text": "gone", "dataset": "d"},
    ]
    data = {"embeddings": items, "metadata": {"model": "m", "total_samples": 2}}
    (tmp_path / "e.json").write_text(json.dumps(data, indent=2 if multi_line else None), encoding="utf-8")
    (row,) = sources.read_embedding_json(spark, str(tmp_path), multi_line).collect()
    assert (row["embedding"], row["text"], row["metadata"]["model"]) == ([1.0, 2.0], "é" * 100, "m")


def test_points_of_json(spark, tmp_path):
    items = [
        {"embedding": [float(i % 5), float(i), 1.0] if i % 6 else None, "split": f"s{i % 2}", "text": f"t{i}", "dataset": "d"}
        for i in range(30)
    ]
    (tmp_path / "e.json").write_text(json.dumps({"embeddings": items, "metadata": {}}), encoding="utf-8")
    points = points_of_json(spark, str(tmp_path), n_neighbors=5, epochs=2)
    assert points.columns == ["x", "y", "split", "dataset", "text"]
    assert {r["text"] for r in points.collect()} == {f"t{i}" for i in range(30) if i % 6}


def test_layout_run(spark):
    flat = json.dumps([{"type": "Text", "text": "a", "bbox": {"xmin": 0, "ymin": 0, "xmax": 0.5, "ymax": 0.5}}])
    reply = json.dumps({"choices": [{"message": {"tool_calls": [{"function": {"arguments": flat}}]}}]})
    rows = [("a", 1, reply), ("a", 2, "{}"), ("b", 1, reply)]
    run = layout_run.parse(spark.createDataFrame(rows, "document string, page int, response string"))
    assert [tuple(r["bbox_pixels"]) for r in run.records.collect()] == [(0, 0, 768, 1024)] * 2
    assert {r["document"]: (r["processed"], r["total"], r["blocks"], r["success"]) for r in run.documents.collect()} == {
        "a": (1, 2, 1, False), "b": (1, 1, 1, True),
    }


def test_latest_state_and_run_totals(spark):
    rows = [
        (0, 10, 1, "w", "success", 5, 1.0, "saving", "f" * 41, 1, 4),
        (0, 10, 2, "w", "skipped", 7, 1.0, "saving", "g", 3, 4),
        (0, 12, 3, "v", "error", 9, 0.0, "loading", "h", 1, 0),
    ]
    schema = "run int, s long, event_id long, worker string, status string, samples long, seconds double, stage string, filename string, current long, total long"
    log = spark.createDataFrame(rows, schema).withColumn("ts", F.timestamp_seconds("s"))
    found = {r["worker"]: (r["filename"], r["pct"]) for r in runlog.latest(log).collect()}
    assert found == {"w": ("g", 75.0), "v": ("h", 0.0)}
    total = runlog.run_totals(log).first()
    assert (total["shards"], total["samples"], total["new_samples"], total["elapsed"], total["rate"]) == (3, 12, 5, 2.0, 6.0)
    status = {r["status"]: (r["shards"], r["samples"], r["rate"]) for r in runlog.status_summary(log).collect()}
    assert status == {"success": (1, 5, 5.0), "skipped": (1, 7, 7.0), "error": (1, 0, 0.0), "all": (3, 12, 6.0)}
    assert [r["rate"] for r in runlog.shard_rates(log).orderBy("event_id").collect()] == [5.0, 7.0, 0.0]


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("range_bytes", [37, 1000])
def test_a_large_object_is_read_in_ranges(spark, tmp_path, indent, range_bytes):
    odd = ['a "quoted" [word', "back\\slash\\\\", '}, {"embedding": [1.0], "text": "no"}', "é日本語 ]", "", 'ends in \\"', None]
    items = [
        {"text": f"{i} {t}" if t is not None else None, "embedding": [i / 2, -1.5e-3] if i % 5 else None, "split": "train", "dataset": "d{"}
        for i, t in enumerate(odd * 4)
    ]
    metadata = {"model": 'm"]', "embedding_dimension": 2}
    objects = [
        {"embeddings": items, "metadata": metadata},
        {"metadata": metadata, "other": [{"embedding": [9.0]}], "more": {"x": {"embedding": [8.0]}}, "embeddings": items[:9]},
        {"embeddings": [], "metadata": metadata},
    ]
    for n, value in enumerate(objects):
        (tmp_path / f"{n}.json").write_text(json.dumps(value, indent=indent, ensure_ascii=bool(n)))
    expected = sources.read_embedding_json(spark, str(tmp_path)).collect()
    found = large_json.read_large_embedding_json(spark, str(tmp_path), range_bytes).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, expected)) and len(found) > 25


def test_small_ranges_share_tasks(spark, tmp_path):
    item = {"text": "t", "embedding": [1.0], "split": "s", "dataset": "d"}
    lines = [json.dumps({"embeddings": [item] * 3, "metadata": {"model": "m"}}) for _ in range(40)]
    (tmp_path / "0.json").write_text("\n".join(lines))
    found = large_json.read_large_embedding_json(spark, str(tmp_path), 64)
    assert found.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism and found.count() == 120


def test_larger_tables_arrive_in_more_files(spark, sf, monkeypatch):
    from checks import queries

    monkeypatch.setattr(queries, "ROWS_PER_ARRIVING_FILE", 50)
    seen = []
    queries._arriving(spark, sf, "events", "event_id", lambda root, files: seen.append((sources.list_files(spark, root, "*.parquet").count(), files)))
    rows = spark.read.parquet(f"{sf}/events.parquet").count()
    assert [n for n, _ in seen] == [2 * seen[0][1], 4 * seen[0][1]] and seen[0][1] == 1 + rows // 200
