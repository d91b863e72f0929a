import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from corpusflow.operators import catalog, provenance, shards, validation
from corpusflow.plans import embedding_run
from corpusflow.plans.embedding_run import validate_tree
from corpusflow.session import stored

ROWS = [
    ("v1", "hub/one", None, "one", "old"),
    ("v2", "hub/two", "SFT", "two", "old"),
    ("v3-a", "hub/a", None, "three/a", "v3"),
    ("v3-b", "hub/b", None, "three/b", "v3"),
]


@pytest.fixture(scope="module")
def known(spark):
    return catalog.registry(spark, ROWS)


def names(df, column="dataset"):
    return sorted(r[column] for r in df.collect())


def test_requests_by_name_and_group(known):
    assert names(catalog.requested(known, [])) == ["v1", "v2", "v3-a", "v3-b"]
    assert names(catalog.requested(known, ["v3", "v1"])) == ["v1", "v3-a", "v3-b"]


def test_specs_with_reasons(spark, known):
    splits = spark.createDataFrame([("v1", "chat"), ("v1", "multilingual_DE"), ("v2", "a:b")], "dataset string, split string")
    specs = ["v1:chat", "v1:MULTILINGUAL", "v1", "x:chat", "v3-a:chat", "v2:a:b", ":chat", "v1:multilingual_DE"]
    df = spark.createDataFrame([(s,) for s in specs], "spec string")
    found = {r["spec"]: r["status"] for r in catalog.resolve_specs(df, known, splits).collect()}
    assert found == {
        "v1:chat": "ok",
        "v1:MULTILINGUAL": "split_not_found",
        "v1": "bad_format",
        "x:chat": "unknown_dataset",
        "v3-a:chat": "not_downloaded",
        "v2:a:b": "ok",
        ":chat": "unknown_dataset",
        "v1:multilingual_DE": "ok",
    }
    assert names(catalog.absent(known, splits)) == ["v3-a", "v3-b"]
    assert names(catalog.chosen_splits(splits, df, known, take_all=True), "split") == ["a:b", "chat"]
    assert names(catalog.chosen_splits(splits, df, known, take_all=False), "split") == ["a:b", "chat", "multilingual_DE"]


def test_summary_names_what_is_missing(spark, known):
    counts = spark.createDataFrame([("v1", "b", 2), ("v1", "a", 3)], "dataset string, split string, n long")
    found = {r["dataset"]: tuple(r)[1:] for r in catalog.dataset_summary(known.select("dataset"), counts).collect()}
    assert found["v1"] == ("a, b", 5, True) and found["v2"] == ("", 0, False)


def test_shard_names_beyond_five_digits(spark):
    df = spark.range(1).select(catalog.file_name(F.lit("d"), F.lit("s"), F.lit(123456), F.lit(7)).alias("f"))
    assert df.first()["f"] == "d-s-123456-of-00007.parquet"


def test_shards_counted_from_files(spark):
    splits = spark.createDataFrame([("d", "a"), ("d", "a-b"), ("d", "none")], "dataset string, split string")
    paths = ["/c/a/1.arrow", "/c/x-a-1.arrow", "/c/x-a-b-1.arrow", "/c/a-b-1.arrow", "/c/x-a", "/a", "/c/a/a-a-a.arrow"]
    files = spark.createDataFrame([("d", p) for p in paths], "dataset string, path string")
    found = {r["split"]: r["total_shards"] for r in catalog.shards_from_files(splits, files).collect()}

    def by_hand(split):
        return max(1, sum(f"/{split}/" in p or f"-{split}-" in p.rsplit("/", 1)[-1] for p in paths))

    assert found == {s: by_hand(s) for s in ("a", "a-b", "none")}


def test_preview_cuts_long_fields(spark):
    df = spark.createDataFrame([(2, "later"), (1, "x" * 501)], "id int, text string")
    assert {r["field"]: r["value"] for r in catalog.preview(df, ["id"]).collect()} == {"id": "1", "text": "x" * 500 + "..."}


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([("d", "s", "t")], "dataset string, split string, text string")
    b = spark.createDataFrame([("e", "s", "m")], "dataset string, split string, prompt string")
    assert catalog.union_samples([a, b]).filter("text is null").first()["prompt"] == "m"


def _write(root, dataset, split, name, table):
    folder = root / dataset / split
    folder.mkdir(parents=True, exist_ok=True)
    pq.write_table(table, folder / name)


def test_tree_with_every_kind_of_file(spark, tmp_path):
    vectors = pa.array([[1.0, 2.0], [3.0, float("nan")]], pa.list_(pa.float64()))
    index = pa.array([0, 1], pa.int64())
    _write(tmp_path, "d", "s", "a.parquet", pa.table({"embeddings": vectors, "original_index": index}))
    _write(tmp_path, "d", "s", "b.parquet", pa.table({"embeddings": vectors}))
    _write(tmp_path, "d", "t", "c.parquet", pa.table({"original_index": index}))
    _write(tmp_path, "e", "s", "empty.parquet", pa.table({"embeddings": vectors[:0], "original_index": index[:0]}))
    (tmp_path / "e" / "s" / "broken.parquet").write_bytes(b"PAR1 this is no parquet PAR1")
    (tmp_path / "e" / "none").mkdir()

    files = validate_tree(spark, str(tmp_path))
    found = {r["file"]: r for r in files.collect()}
    assert {f: (r["valid"], r["rows"], r["dim"]) for f, r in found.items()} == {
        "a.parquet": (True, 2, 2),
        "b.parquet": (True, 2, 2),
        "c.parquet": (False, 2, 0),
        "empty.parquet": (True, 0, 0),
        "broken.parquet": (False, 0, 0),
    }
    assert found["a.parquet"]["warnings"] == ["Found 1 NaN values"]
    assert found["b.parquet"]["warnings"] == ["Found 1 NaN values", "Missing 'original_index' column"]
    assert found["c.parquet"]["errors"] == ["Missing 'embeddings' column"]
    assert found["broken.parquet"]["errors"][0].startswith("Error reading file")
    assert found["a.parquet"]["file_bytes"] == (tmp_path / "d" / "s" / "a.parquet").stat().st_size

    total = validation.overall(files).first()
    assert (total["all_valid"], total["dims"], total["datasets"], total["splits"], total["files"], total["samples"]) == (
        False, [2], 2, 3, 5, 6,
    )
    levels = {(r["dataset"], r["split"]): (r["level"], r["samples"], r["files"]) for r in validation.report(files).collect()}
    assert levels[("d", None)] == ("dataset", 6, 3) and levels[(None, None)] == ("all", 6, 5)
    assert validation.issues(files).filter("kind = 'error'").count() == 2
    assert validation.first_valid_file(files).first()["file"] == "a.parquet"


@pytest.mark.parametrize("group", [0, 1, 2])
def test_a_damaged_row_group_makes_its_file_invalid(spark, tmp_path, group):
    n = 6000
    vectors = pa.array([[float(i), i / 3] for i in range(n)], pa.list_(pa.float64()))
    table = pa.table({"embeddings": vectors, "original_index": pa.array(range(n), pa.int64())})
    for shard in (0, 1):
        name = f"x-0000{shard}-of-00002.parquet"
        _write(tmp_path, "d", "s", name, table.slice(0, 100))
        pq.write_table(table, tmp_path / "d" / "s" / name, row_group_size=n // 3, compression="snappy", use_dictionary=False)
    path = tmp_path / "d" / "s" / "x-00001-of-00002.parquet"
    column = pq.ParquetFile(path).metadata.row_group(group).column(0)
    data = bytearray(path.read_bytes())
    data[column.data_page_offset : column.data_page_offset + column.total_compressed_size] = b"\xff" * column.total_compressed_size
    path.write_bytes(data)

    files = validate_tree(spark, str(tmp_path))
    found = {r["file"]: r for r in files.collect()}
    assert found["x-00000-of-00002.parquet"]["valid"] and found["x-00000-of-00002.parquet"]["rows"] == n
    broken = found[path.name]
    assert not broken["valid"] and broken["rows"] < n and f"of {n} rows" in broken["errors"][-1]
    plan = files.select("dataset", "split", F.lit(2).alias("total_shards"))
    assert [r["shard_id"] for r in shards.done_from_files(files, plan).collect()] == [0]


def test_only_changed_files_are_read_again(spark, tmp_path, monkeypatch):
    table = pa.table({"embeddings": pa.array([[1.0, 2.0]] * 3, pa.list_(pa.float64())), "original_index": pa.array(range(3), pa.int64())})
    for name in ("a.parquet", "b.parquet", "c.parquet"):
        _write(tmp_path, "d", "s", name, table)
    read = []
    for reader in ("read_embedding_tree", "stored_rows"):
        plain = getattr(embedding_run.sources, reader)
        monkeypatch.setattr(embedding_run.sources, reader, lambda s, where, f=plain: read.append(where) or f(s, where))
    root = str(tmp_path)

    def checked(known):
        del read[:]
        found = stored(embedding_run.validate_changed(spark, root, known))
        return found, {r["file"]: (r["valid"], r["rows"]) for r in found.collect()}

    first, report = checked(None)
    assert report == dict.fromkeys(["a.parquet", "b.parquet", "c.parquet"], (True, 3)) and len(read) == 2
    again, same = checked(first)
    assert same == report and read == []  # no file of an unchanged tree is opened
    _write(tmp_path, "d", "s", "b.parquet", table.slice(0, 2))
    _write(tmp_path, "d", "t", "new.parquet", table)
    (tmp_path / "d" / "s" / "c.parquet").unlink()
    _, later = checked(again)
    assert later == {"a.parquet": (True, 3), "b.parquet": (True, 2), "new.parquet": (True, 3)}
    assert all(sorted(p.rpartition("/")[2] for p in where) == ["b.parquet", "new.parquet"] for where in read)


def test_ragged_vectors_and_first_row(spark):
    rows = [("d", "s", "f", [1.0], 5), ("d", "s", "f", [1.0, 2.0, 3.0], 2), ("d", "s", "g", None, 0), ("d", "s", "g", [1.0], 1)]
    df = spark.createDataFrame(rows, "dataset string, split string, file string, embeddings array<double>, original_index long")
    found = {r["file"]: r for r in validation.validate_files(df.repartition(3), check_values=False).collect()}
    assert (found["f"]["dim"], found["f"]["min_dim"], found["f"]["max_dim"], found["f"]["valid"]) == (3, 1, 3, True)
    assert (found["g"]["valid"], found["g"]["errors"]) == (False, ["Invalid embedding type"])


def test_overall_of_nothing_is_valid(spark):
    df = spark.createDataFrame([], "dataset string, split string, file string, embeddings array<double>, original_index long")
    total = validation.overall(validation.validate_files(df)).first()
    assert (total["all_valid"], total["dims"], total["samples"]) == (True, [], 0)


@pytest.mark.parametrize(("embedded", "source", "expected"), [(9, 10, (-1, 90.0, True)), (8, 10, (-2, 80.0, False)), (1, 0, (1, 0.0, True))])
def test_source_comparison(spark, embedded, source, expected):
    e = spark.createDataFrame([("d", "s", embedded), ("d", "unknown", 1)], "dataset string, split string, embedded long")
    s = spark.createDataFrame([("d", "s", source)], "dataset string, split string, source long")
    found = {r["split"]: (r["diff"], r["pct"], r["matches"]) for r in validation.compare_source(e, s).collect()}
    assert found == {"s": expected, "unknown": (None, None, None)}


def test_attach_and_legend(spark):
    vectors = spark.createDataFrame([("d", "s", 0, 3, [1.0])], "dataset string, split string, shard_id int, original_index long, embeddings array<double>")
    texts = spark.createDataFrame([("d", "s", 0, 3, "é" * 150), ("d", "s", 1, 3, "no")], "dataset string, split string, shard_id int, original_index long, text string")
    (row,) = provenance.attach_source(vectors, texts).collect()
    assert row["text"] == "é" * 100
    labels = spark.createDataFrame([("b",), ("a",), ("b",)], "split string")
    assert {(r["split"], r["slot"]) for r in provenance.with_slots(labels).collect()} == {("a", 0), ("b", 1)}


def test_tree_of_single_precision_vectors_and_of_nothing(spark, tmp_path):
    vectors = pa.array([[0.5, 1.5], [2.5, float("inf")]], pa.list_(pa.float32()))
    _write(tmp_path / "tree", "d", "s", "a.parquet", pa.table({"embeddings": vectors, "original_index": pa.array([0, 1], pa.int64())}))
    (row,) = validate_tree(spark, str(tmp_path / "tree")).collect()
    assert (row["valid"], row["rows"], row["dim"], row["warnings"]) == (True, 2, 2, ["Found 1 Inf values"])
    (tmp_path / "none" / "d" / "s").mkdir(parents=True)
    assert validate_tree(spark, str(tmp_path / "none")).count() == 0
