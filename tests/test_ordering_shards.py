import math

import pytest
from pyspark.sql import functions as F

from corpusflow.operators import encode, ordering, runlog, shards
from corpusflow.plans import embedding_run
from corpusflow.sources import writers
from test_encode import Picky


def contiguous(n, k):
    """Shard and position of each of n rows, by cutting a list."""
    out, at = [], 0
    for shard in range(k):
        size = n // k + (shard < n % k)
        out += [(shard, i) for i in range(size)]
        at += size
    return out


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_positions_do_not_depend_on_partitions(spark, partitions):
    rows = [(["a", "b"][i % 3 == 0], i * i) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, k long").repartition(partitions)
    found = ordering.positions(df, ["g"], ["k"], "idx", "n", rows_per_bucket=40).collect()
    for group in "ab":
        keys = sorted(k for g, k in rows if g == group)
        assert sorted((r["idx"], r["k"], r["n"]) for r in found if r["g"] == group) == [
            (i, k, len(keys)) for i, k in enumerate(keys)
        ]


def test_one_value_with_a_third_of_all_rows_is_cut_by_the_second_column(spark):
    df = spark.range(3000).select(
        F.lit(1).alias("g"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), (3000 - F.col("id")).alias("t")
    )
    buckets = ordering.bucketed(df, ["k", "t"], rows_per_bucket=100)
    largest = buckets.groupBy("_bucket").count().agg(F.max("count")).first()[0]
    assert largest < 400
    found = ordering.positions(df, ["g"], ["k", "t"], rows_per_bucket=100).collect()
    expected = sorted((r["k"], r["t"]) for r in found)
    assert [(r["k"], r["t"]) for r in sorted(found, key=lambda r: r["idx"])] == expected


def test_rows_without_order_value_are_kept_last(spark):
    df = spark.createDataFrame([(1, i if i % 4 else None, i) for i in range(100)], "g int, k long, u long")
    found = ordering.positions(df, ["g"], ["k", "u"], rows_per_bucket=10).collect()
    assert sorted(r["idx"] for r in found) == list(range(100))
    assert all((r["k"] is None) == (r["idx"] >= 75) for r in found)


@pytest.mark.parametrize("rows_per_bucket", [5, 1_000_000])
def test_text_keys_are_numbered_at_any_size(spark, rows_per_bucket):
    keys = ["", "é", "Z", 'quo"te', "back\\slash", "line\nbreak", *[f"http://host/{i}" for i in range(40)]]
    df = spark.createDataFrame([(k,) for k in [*keys, None]], "k string")
    found = ordering.positions(df, [], ["k"], rows_per_bucket=rows_per_bucket).collect()
    ranked = [r["k"] for r in sorted(found, key=lambda r: r["idx"])]
    assert ranked == [*sorted(keys, key=str.encode), None]


def test_odd_numbers_and_times_find_their_buckets(spark):
    rows = [(float(i),) for i in range(30)] + [(float("inf"),), (float("-inf"),), (float("nan"),), (None,)]
    found = ordering.positions(spark.createDataFrame(rows, "k double"), [], ["k"], rows_per_bucket=3).collect()
    ranked = [r["k"] for r in sorted(found, key=lambda r: r["idx"])]
    assert ranked[:2] == [float("-inf"), 0.0] and ranked[30:32] == [29.0, float("inf")]
    assert math.isnan(ranked[32]) and ranked[33] is None
    times = spark.range(50).select(F.timestamp_micros(F.col("id") * 7 + 1).alias("k"), "id")
    found = ordering.positions(times, [], ["k"], rows_per_bucket=4).collect()
    assert all(r["idx"] == r["id"] for r in found)


def test_no_rows_have_no_positions(spark):
    assert ordering.positions(spark.range(0), [], ["id"]).count() == 0


def test_run_shuffles_texts_once(spark):
    rows = [("d", "s", i, f"text {i}") for i in range(30)]
    samples = spark.createDataFrame(rows, "dataset string, split string, id long, text string")
    texts = embedding_run.sharded_texts(samples, "id", F.lit(3)).filter("has_text")
    plan = encode.embed(texts, "text", keep=["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition" not in plan


@pytest.mark.parametrize(("n", "k"), [(20, 7), (3, 5), (14, 7), (1, 1), (0, 3)])
def test_contiguous_shards(spark, n, k):
    df = spark.range(n).select(F.lit("d").alias("dataset"), F.lit("s").alias("split"), "id")
    found = shards.assign(df, "id", F.lit(k), rows_per_bucket=4).orderBy("id").collect()
    assert [(r["shard_id"], r["original_index"]) for r in found] == contiguous(n, k)


def test_shards_of_known_size(spark):
    df = spark.range(25).select(F.lit("d").alias("dataset"), F.when(F.col("id") < 5, "x").otherwise("y").alias("split"), "id")
    found = shards.assign(df, "id", shards.shard_count(F.col("_n"), 8)).groupBy("split").agg(
        F.max("total_shards").alias("k"), F.countDistinct("shard_id").alias("used")
    )
    assert {r["split"]: (r["k"], r["used"]) for r in found.collect()} == {"x": (1, 1), "y": (3, 3)}


def test_pending_and_skipped_make_up_the_plan(spark):
    plan = spark.range(10).select(F.lit("d").alias("dataset"), F.lit("s").alias("split"), F.col("id").alias("shard_id"))
    done = plan.filter("shard_id % 3 = 0")
    assert shards.pending(plan, done).count() + shards.skipped(plan, done).count() == 10


def test_run_skips_done_shards_and_keeps_gaps_in_positions(spark):
    rows = [("d", "s", i, None if i == 1 else " " if i >= 9 else f"text {i}") for i in range(12)]
    samples = spark.createDataFrame(rows, "dataset string, split string, id long, text string")
    done = spark.createDataFrame([("d", "s", 2, 3)], "dataset string, split string, shard_id int, samples long")
    run = embedding_run.embed_shards(samples, "id", F.lit(4), done)
    status = {r["shard_id"]: (r["status"], r["samples"]) for r in run.status.collect()}
    assert status == {0: ("success", 2), 1: ("success", 3), 2: ("skipped", 3), 3: ("no_text", 0)}
    positions = sorted((r["shard_id"], r["original_index"]) for r in run.embeddings.collect())
    assert positions == [(0, 0), (0, 2), (1, 0), (1, 1), (1, 2)]


def test_refused_rows_mark_their_shard(spark):
    rows = [("d", "s", i, "bad" if i == 5 else "good") for i in range(9)]
    samples = spark.createDataFrame(rows, "dataset string, split string, id long, text string")
    none = spark.createDataFrame([], "dataset string, split string, shard_id int, samples long")
    run = embedding_run.embed_shards(samples, "id", F.lit(3), none, Picky())
    assert {r["shard_id"]: (r["status"], r["samples"]) for r in run.status.collect()} == {
        0: ("success", 3), 1: ("error", 2), 2: ("success", 3),
    }


def test_only_valid_files_count_as_done(spark):
    files = [("d", "s", "d-s-00000-of-00002.parquet", True, 5), ("d", "s", "d-s-00001-of-00002.parquet", False, 4), ("d", "s", "x.parquet", True, 1)]
    df = spark.createDataFrame(files, "dataset string, split string, file string, valid boolean, rows long")
    for total, done in ((2, [("d", "s", 0, 5)]), (3, [])):
        plan = spark.createDataFrame([("d", "s", total)], "dataset string, split string, total_shards int")
        assert [tuple(r) for r in shards.done_from_files(df, plan).collect()] == done


def test_only_whole_shards_of_the_plan_are_committed(spark, tmp_path):
    root = str(tmp_path)
    rows = [("d", None if k == 2 else "s", k, 4, [1.0], i) for k in range(4) for i in range(10)]
    schema = "dataset string, split string, shard_id int, total_shards int, embeddings array<double>, original_index long"
    vectors = spark.createDataFrame(rows, schema)
    plan = vectors.select(*shards.SHARD_KEY, "total_shards").distinct()

    def todo():
        return sorted(r["shard_id"] for r in shards.pending(plan, writers.committed_shards(spark, root, plan)).collect())

    writers.write_shards(vectors.filter("shard_id < 3"), root)
    writers.write_embeddings(vectors.filter("shard_id = 3"), root)
    assert todo() == [3]  # its files are there, its entry is not
    writers.write_embeddings(vectors.filter("shard_id = 0 AND original_index < 5"), root)
    writers.write_shards(vectors.filter("shard_id = 1").withColumn("total_shards", F.lit(5)), root)
    assert todo() == [0, 1, 3]
    writers.write_shards(vectors.filter("shard_id <> 2"), root)
    assert todo() == []


def test_running_totals_across_buckets(spark):
    kinds = ["success", "skipped", "no_text", "error"]
    rows = [(i % 2, 1000 + i // 5, i, kinds[i % 4], i) for i in range(400)]
    log = spark.createDataFrame(rows, "run int, s long, event_id long, status string, samples long").withColumn(
        "ts", F.timestamp_seconds("s")
    )
    found = {r["event_id"]: r for r in runlog.progress(log, rows_per_bucket=30).collect()}
    for run in (0, 1):
        done = total = 0
        for r, s, event, status, samples in rows:
            if r != run:
                continue
            done, total = done + 1, total + (samples if status in ("success", "skipped") else 0)
            elapsed = s - 1000
            assert (found[event]["done"], found[event]["total_samples"]) == (done, total)
            assert math.isclose(found[event]["avg_rate"], total / elapsed if elapsed else 0.0)


@pytest.mark.parametrize("at", ["2024-01-01 00:00:00.123456", "2024-01-01 00:00:00"])
def test_rows_at_one_instant_fill_many_buckets(spark, at):
    rows = spark.range(1000).select(F.lit(at).cast("timestamp").alias("ts"), F.col("id").alias("n"))
    sizes = [r["count"] for r in ordering.bucketed(rows, ["ts", "n"], 100).groupBy("_bucket").count().collect()]
    assert len(sizes) >= 10 and max(sizes) <= 200


def test_borders_keep_their_types(spark):
    exact = "decimal(30,12)"
    rows = spark.range(400).select(
        F.expr(f"cast(1 as {exact}) + cast(id as {exact}) / 1000000000000").alias("a"), F.expr("cast(string(id) as binary)").alias("b")
    )
    numbered = ordering.positions(rows, [], ["a", "b"], rows_per_bucket=20).orderBy("idx").collect()
    assert [int(bytes(r["b"])) for r in numbered] == list(range(400))


def test_rows_without_a_group_are_a_group(spark):
    rows = spark.createDataFrame([(i, "a" if i % 3 else None, "x" if i % 2 else None) for i in range(60)], "id long, g string, h string")
    found = ordering.positions(rows, ["g", "h"], ["id"], "idx", "n", rows_per_bucket=7).collect()
    expected = {}
    for i in range(60):
        expected.setdefault((i % 3 > 0, i % 2 > 0), []).append(i)
    at = {i: (k, len(ids)) for ids in expected.values() for k, i in enumerate(ids)}
    assert {r["id"]: (r["idx"], r["n"]) for r in found} == at


def test_thousands_of_buckets(spark):
    """As many as large tables have: the plan must not grow with their number, nor may each be a task."""
    rows = spark.range(20_000).select(((F.col("id") * 7919) % 20_000).alias("k"))
    buckets = ordering.bucketed(rows, ["k"], rows_per_bucket=2)
    assert ordering.borders(rows, ["k"], 20_000, 2).count() == 10_000
    assert buckets.groupBy("_bucket").count().agg(F.max("count")).first()[0] == 2
    found = ordering.running(rows, [], ["k"], {"n": F.lit(1)}, rows_per_bucket=2)
    assert found.filter("n <> k + 1").count() == 0 and found.count() == 20_000
