"""Readers of many small files: tasks follow bytes and cores, not files."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from corpusflow.plans import embedding_run
from corpusflow.session import small_files
from corpusflow.sources import archives, samples, writers


@pytest.fixture
def small_tasks(spark):
    kept = {name: spark.conf.get(name) for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8m")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    for name, value in kept.items():
        spark.conf.set(name, value)


def tasks(df):
    return df.rdd.getNumPartitions()


def test_settings_are_kept(spark, small_tasks):
    session = small_files(spark)
    assert session.conf.get("spark.sql.shuffle.partitions") == "3"
    assert session.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")
    assert session.conf.get("spark.sql.files.openCostInBytes") == str(64 * 1024)
    assert spark.conf.get("spark.sql.files.openCostInBytes") != str(64 * 1024)
    listing = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    assert int(session.conf.get(listing)) <= 4 * spark.sparkContext.defaultParallelism < int(spark.conf.get(listing))


def test_small_archives_share_tasks(spark, small_tasks, tmp_path):
    for i in range(200):
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w") as archive:
            archive.writestr(archives.MEMBER, f'{{"elements": [{{"Text": "{i}"}}]}}')
        (tmp_path / f"a{i}.zip").write_bytes(buffer.getvalue())
    found = archives.read_archives(spark, str(tmp_path))
    most = 2 * spark.sparkContext.defaultParallelism
    assert tasks(found) <= most < 100
    texts = archives.elements(found).join(spark.range(200).select(F.concat(F.lit("a"), "id").alias("document")), "document")
    assert sorted(int(r["elements"][0]["Text"]) for r in texts.collect()) == list(range(200))
    structured = archives.read_structured(spark, str(tmp_path))
    assert structured.filter("status = 'ok'").count() == 200


def test_small_pages_share_tasks(spark, small_tasks, tmp_path):
    for i in range(200):
        folder = tmp_path / f"d{i % 3}"
        folder.mkdir(exist_ok=True)
        (folder / f"page_{i}.json").write_text(f'[{{"page": {i}, "block_id": 0, "text": "t"}}, {{"page": {i}, "block_id": 1}}]')
    found = samples.read_block_pages(spark, str(tmp_path))
    assert tasks(found) <= 2 * spark.sparkContext.defaultParallelism
    counts = {r["document"]: r["count"] for r in found.groupBy("document").count().collect()}
    assert counts == {"d0": 134, "d1": 134, "d2": 132}


def test_pages_are_listed_and_read_by_tasks(spark, tmp_path, monkeypatch):
    good = '[{"page": 1, "block_id": 0, "text": "t\u00e9"}, {"page": 1, "block_id": 1}]'
    contents = {
        "ok": good.encode(), "sp ace": good.encode(), "u%41+": good.encode(), "bom": b"\xef\xbb\xbf" + good.encode(), "u16": good.encode("utf-16"),
        "empty": b"", "blank": b" \n", "none": b"[]", "one": b'{"page": 3}', "bad": b"hello", "cut": good.encode()[:40],
        "types": b'[{"page": "x"}, {"page": 2}]', "_hidden": good.encode(),
    }
    for name, content in contents.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "page_1.json").write_bytes(content)
    (tmp_path / "ok" / "deep").mkdir()
    for path in ("top.json", "ok/deep/page_2.json", "ok/_x.json", "ok/.x.json", "ok/x.txt"):
        (tmp_path / path).write_text(good)
    both = [(1, 0, "t\u00e9"), (1, 1, None)]
    expected = {name: both for name in ("ok", "sp ace", "u%41+", "bom", "u16", "deep", tmp_path.name)}
    expected |= {"one": [(3, None, None)], "bad": [(None,) * 3], "cut": [(None,) * 3], "types": [(2, None, None), (None,) * 3]}

    def found(root):
        pages, rows = samples.read_block_pages(spark, root), {}
        for r in pages.select("document", "page", "block_id", "text").collect():
            rows.setdefault(r["document"], []).append(tuple(r)[1:])
        return pages, {name: sorted(them, key=repr) for name, them in rows.items()}

    pages, rows = found(str(tmp_path))
    assert rows == {name: sorted(them, key=repr) for name, them in expected.items()}
    assert not any(file.endswith(".json") for file in pages.inputFiles())  # no index of the files on the driver
    monkeypatch.setattr(samples, "WHOLE_BYTES", 60)  # some are streamed by Spark's reader
    assert found(f"file:{tmp_path}")[1] == rows
    monkeypatch.setattr(samples, "_known_store", lambda root: False)
    assert found(str(tmp_path))[1] == rows


def test_many_small_shards_are_written_by_many_tasks(spark, tmp_path):
    rows = spark.range(400).selectExpr(
        "'d' AS dataset", "'s' AS split", "cast(id div 2 AS int) AS shard_id", "array(1.0D) AS embeddings", "id % 2 AS original_index"
    )
    writers.write_embeddings(rows, str(tmp_path / "e"))
    files = list((tmp_path / "e").rglob("*.parquet"))
    assert len(files) == 200 and len({file.name.split("-")[1] for file in files}) > 2
    assert samples.read_shards(spark, str(tmp_path / "e")).count() == 400


def test_a_large_split_is_encoded_by_many_tasks(spark):
    rows = spark.range(60_000).selectExpr("'d' AS dataset", "'s' AS split", "id", "'t' AS text")
    done = spark.createDataFrame([], "dataset string, split string, shard_id int, samples long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # rows of this test are few bytes
    try:
        found = embedding_run.embed_shards(rows, "id", F.lit(7), done).embeddings
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = found.groupBy(F.input_file_name()).count().collect()
    assert len(files) > 1 and max(r["count"] for r in files) < 60_000
    assert found.select("shard_id", "original_index").distinct().count() == 60_000
