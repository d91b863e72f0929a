"""Registered queries. Each takes the session and the folder with the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from checks import inputs
from corpusflow.functions.text import data_uri, decoded, size_label
from corpusflow.functions.vectors import dim
from corpusflow.operators import (
    blocks,
    catalog,
    encode,
    fetch,
    neighbors,
    ordering,
    projection,
    provenance,
    runlog,
    shards,
    text_samples,
    validation,
)
from corpusflow.plans import embedding_run, layout_run
from corpusflow.schemas import BBOX
from corpusflow.session import fresh_path, stored
from corpusflow.sources import archives, large_json, responses, samples as sources, writers
from corpusflow.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DIGITS = 6
SHARDS = 7
ROWS_PER_SHARD = 30
#: Small, so that numbering runs over many buckets at every size of the tables.
ROWS_PER_BUCKET = 100
LOG_ROWS_PER_BUCKET = 1000
ITEMS_PER_OBJECT = 5
#: The epoch that is compared with SQL.
STEP_EPOCH = 3
#: A file that arrives is written by one task: larger tables arrive in more files.
ROWS_PER_ARRIVING_FILE = 50_000
#: Small, so that neighbours are searched over many blocks at every size of the tables.
BLOCK_ROWS = 64


def _tasks(spark: SparkSession) -> int:
    """Tasks for rows of a few large files that each need much work."""
    return spark.sparkContext.defaultParallelism


def registered(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _rounded(*names: str) -> list[Column]:
    return [F.round(n, DIGITS).alias(n) for n in names]


def _long(*names: str) -> list[Column]:
    return [F.col(n).cast("long").alias(n) for n in names]


def _shown(*names: str) -> list[Column]:
    """Text columns with a dash where there is no value."""
    return [F.coalesce(n, F.lit("-")).alias(n) for n in names]


# Catalogue


@registered
def registry_groups(spark, sf_dir):
    known = inputs.known_datasets(spark, sf_dir)
    return catalog.requested(known, ["next", "src0"]).select("grp", "dataset", "source_name")


@registered
def list_splits(spark, sf_dir):
    return catalog.list_splits(inputs.samples(spark, sf_dir))


@registered
def absent_datasets(spark, sf_dir):
    splits = catalog.list_splits(inputs.samples(spark, sf_dir))
    return catalog.absent(inputs.known_datasets(spark, sf_dir), splits).select("dataset", "grp")


@registered
def resolve_specs(spark, sf_dir):
    splits = catalog.list_splits(inputs.samples(spark, sf_dir))
    found = catalog.resolve_specs(inputs.specs(spark, sf_dir), inputs.known_datasets(spark, sf_dir), splits)
    return found.select("spec", *_shown("dataset", "split"), "status")


@registered
def chosen_splits(spark, sf_dir):
    splits = catalog.list_splits(inputs.samples(spark, sf_dir))
    known = inputs.known_datasets(spark, sf_dir)
    named = splits.select(F.concat_ws(":", "dataset", "split").alias("spec"))
    modes = [
        catalog.chosen_splits(splits, named, known, take_all).withColumn("take_all", F.lit(take_all))
        for take_all in (True, False)
    ]
    return catalog.union_samples(modes)


@registered
def split_counts(spark, sf_dir):
    return catalog.split_counts(inputs.samples(spark, sf_dir))


@registered
def dataset_summary(spark, sf_dir):
    counts = catalog.split_counts(inputs.samples(spark, sf_dir))
    return catalog.dataset_summary(inputs.known_datasets(spark, sf_dir).select("dataset"), counts)


@registered
def shard_plan(spark, sf_dir):
    counts = catalog.split_counts(inputs.samples(spark, sf_dir))
    k = shards.shard_count(F.col("n"), ROWS_PER_SHARD)
    return catalog.shard_plan(counts.withColumn("total_shards", k)).select(
        "dataset", "split", *_long("shard_id", "total_shards"), "spec", "file"
    )


@registered
def shards_from_files(spark, sf_dir):
    rows = inputs.samples(spark, sf_dir)
    number = F.col("doc_id") % 10
    path = (
        F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("/c/"), "dataset", F.lit("/"), "split", F.lit("/"), number))
        .when(F.col("doc_id") % 3 == 1, F.concat(F.lit("/c/"), "dataset", F.lit("/h/x-"), "split", F.lit("-"), number))
        .otherwise(F.concat(F.lit("/c/"), "dataset", F.lit("/other/"), number))
    )
    files = rows.select("dataset", path.alias("path")).distinct()
    splits = catalog.list_splits(rows).select("dataset", "split")
    return catalog.shards_from_files(splits, files).select("dataset", "split", *_long("total_shards"))


@registered
def union_catalog(spark, sf_dir):
    second = inputs.table(spark, sf_dir, "benchmark").select(
        F.lit("benchmark").alias("dataset"),
        F.concat(F.lit("part"), F.col("item_id") % 3).alias("split"),
        "item_id",
        "text",
    )
    return catalog.split_counts(catalog.union_samples([inputs.samples(spark, sf_dir), second]))


# Shards and resume


@registered
def shard_assign(spark, sf_dir):
    rows = inputs.samples(spark, sf_dir).drop("text")
    found = shards.assign(rows, "doc_id", F.lit(SHARDS), ROWS_PER_BUCKET)
    return found.select("doc_id", *_long("shard_id"), "original_index")


@registered
def shard_assign_text(spark, sf_dir):
    """Samples with a text for a key, here a digest of the id."""
    rows = inputs.samples(spark, sf_dir).select("dataset", "split", F.md5(F.col("doc_id").cast("string")).alias("uuid"))
    found = shards.assign(rows, "uuid", F.lit(SHARDS), ROWS_PER_BUCKET)
    return found.select("uuid", *_long("shard_id"), "original_index")


@registered
def shard_assign_unnamed(spark, sf_dir):
    """Samples of which some have no split, some no dataset and some neither."""
    rows = inputs.unnamed(inputs.samples(spark, sf_dir).drop("text"))
    found = shards.assign(rows, "doc_id", F.lit(SHARDS), ROWS_PER_BUCKET)
    return found.select("doc_id", *_long("shard_id"), "original_index")


@registered
def numbered_instant(spark, sf_dir):
    """All events at one instant, numbered in buckets of bounded size."""
    at = F.lit("2024-01-01 00:00:00.123456").cast("timestamp")
    events = inputs.table(spark, sf_dir, "events").select("event_id", "event_type", at.alias("ts"))
    order = ["ts", "event_id"]
    numbered = ordering.positions(events, ["event_type"], order, rows_per_bucket=LOG_ROWS_PER_BUCKET)
    sizes = ordering.bucketed(events, order, LOG_ROWS_PER_BUCKET)
    n = F.count("*").over(Window.partitionBy("_bucket"))
    sizes = sizes.select("event_id", (n <= 4 * LOG_ROWS_PER_BUCKET).alias("bounded"))
    return numbered.join(sizes, "event_id").select("event_id", "idx", "bounded")


@registered
def resume_pending(spark, sf_dir):
    done = inputs.table(spark, sf_dir, "labels")
    return shards.pending(inputs.samples(spark, sf_dir).select("dataset", "split", "doc_id"), done, ["doc_id"])


@registered
def resume_committed(spark, sf_dir):
    """What is to be done again after one dataset's shards were half overwritten and another's cut anew."""
    root = fresh_path(spark, "committed")
    rows = _sharded_run(spark, sf_dir, resume=False).embeddings
    writers.write_shards(rows, root)
    writers.write_embeddings(rows.filter("dataset = 'src1' AND original_index % 2 = 0"), root)
    other = rows.filter("dataset = 'src2'").withColumn("total_shards", F.col("total_shards") + 1)
    writers.write_shards(other, root)
    plan = rows.select(*shards.SHARD_KEY, "total_shards").distinct()
    todo = shards.pending(plan, writers.committed_shards(spark, root, plan))
    return todo.select("dataset", "split", *_long("shard_id", "total_shards"))


@registered
def resume_skipped(spark, sf_dir):
    done = inputs.table(spark, sf_dir, "labels")
    return shards.skipped(inputs.samples(spark, sf_dir).select("dataset", "split", "doc_id"), done, ["doc_id"])


def _done_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First shard of every split that has labelled documents."""
    labelled = inputs.samples(spark, sf_dir).join(inputs.table(spark, sf_dir, "labels"), "doc_id", "left_semi")
    counts = catalog.split_counts(labelled).withColumnRenamed("n", "samples")
    return counts.withColumn("shard_id", F.lit(0))


def _sharded_run(spark: SparkSession, sf_dir: str, resume: bool, factory=None) -> embedding_run.ShardRun:
    rows = inputs.some_blank(inputs.samples(spark, sf_dir))
    done = _done_shards(spark, sf_dir)
    k = shards.shard_count(F.col("_n"), ROWS_PER_SHARD)
    return embedding_run.embed_shards(rows, "doc_id", k, done if resume else done.limit(0), factory)


@registered
def shard_status(spark, sf_dir):
    """Shards done, without text, and with texts that the encoder refuses."""
    status = _sharded_run(spark, sf_dir, resume=True, factory=inputs.Choosy()).status
    return status.select("dataset", "split", *_long("shard_id"), "shard", "status", "samples")


@registered
def embed_shards(spark, sf_dir):
    rows = _sharded_run(spark, sf_dir, resume=True).embeddings
    return rows.select(
        "dataset", "split", *_long("shard_id"), "original_index", "doc_id",
        F.round(F.get("embeddings", F.lit(0)), DIGITS).alias("x0"),
    )


@registered
def embedding_report(spark, sf_dir):
    name = F.concat_ws("-", "dataset", "split", "shard_id")
    rows = _sharded_run(spark, sf_dir, resume=False).embeddings.withColumn("file", name)
    return embedding_run.validation_report(rows).select(*_shown("dataset", "split"), "level", "samples", "files", "invalid")


# Texts


@registered
def text_messages(spark, sf_dir):
    chats = inputs.messages(spark, sf_dir)
    return text_samples.with_text(chats, exclude=["conv_id"]).select("conv_id", "text")


@registered
def text_turns(spark, sf_dir):
    return text_samples.text_of_turns(inputs.table(spark, sf_dir, "conversations"))


@registered
def text_field(spark, sf_dir):
    rows = inputs.some_blank(inputs.samples(spark, sf_dir)).withColumn("prompt", F.lit("not the text"))
    found = text_samples.with_text(rows, exclude=["dataset", "split", "doc_id"])
    return text_samples.only_with_text(found).select("doc_id", "text")


@registered
def text_fallback(spark, sf_dir):
    pages = inputs.table(spark, sf_dir, "pages").withColumn("short", F.lit("ten chars."))
    return text_samples.with_text(pages, exclude=["page_id"]).select("page_id", "text")


@registered
def sample_preview(spark, sf_dir):
    return catalog.preview(inputs.table(spark, sf_dir, "documents"), ["doc_id"])


@registered
def split_previews(spark, sf_dir):
    return catalog.split_previews(inputs.samples(spark, sf_dir), ["doc_id"])


@registered
def read_samples(spark, sf_dir):
    """Samples staged in folders and read back, in two formats."""
    found = []
    for fmt in ("parquet", "json"):
        root = fresh_path(spark, "staged")
        rows = inputs.samples(spark, sf_dir)
        rows.write.format(fmt).partitionBy("dataset", "split").save(root)
        schema = rows.select("doc_id", "text").schema
        found += [sources.read_samples(spark, root, schema, fmt), sources.read_samples(spark, root, schema, fmt, "chat")]
    return catalog.union_samples(found).groupBy("dataset", "split").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("n_chars")
    )


# Embedding


def _components(rows: DataFrame, *keep: str) -> DataFrame:
    return rows.select(*keep, F.posexplode("embeddings").alias("component", "x")).select(
        *keep, *_long("component"), *_rounded("x")
    )


@registered
def embed_documents(spark, sf_dir):
    docs = inputs.table(spark, sf_dir, "documents").withColumn("n_tokens", encode.token_count(F.col("text")).cast("long"))
    rows = encode.embed(docs, "text", keep=["doc_id", "n_tokens"], tasks=_tasks(spark))
    return _components(rows.withColumn("dim", dim(F.col("embeddings")).cast("long")), "doc_id", "n_tokens", "dim")


@registered
def embed_faulty(spark, sf_dir):
    """Single-precision vectors of an encoder whose results are short, wide or not finite for some texts."""
    docs = inputs.table(spark, sf_dir, "documents")
    rows = encode.embed(docs, "text", inputs.Faulty(), keep=["doc_id"], tasks=_tasks(spark), numbers="float")
    return rows.select(
        "doc_id", F.col("error").isNotNull().alias("failed"), F.round(F.get("embeddings", F.lit(0)).cast("double"), 4).alias("x0")
    )


@registered
def embed_queries(spark, sf_dir):
    """The input-type prefix and the encoder's token limit, here its usual 8192."""
    docs = inputs.table(spark, sf_dir, "documents")
    rows = encode.embed(docs, "text", encode.TokenHash(max_tokens=8192), prefix="query: ", keep=["doc_id"], tasks=_tasks(spark))
    return _components(rows, "doc_id")


@registered
def attach_source(spark, sf_dir):
    rows = inputs.some_blank(inputs.samples(spark, sf_dir))
    k = shards.shard_count(F.col("_n"), ROWS_PER_SHARD)
    texts = embedding_run.sharded_texts(rows, "doc_id", k)
    vectors = encode.embed(texts.filter("has_text"), "text", keep=list(provenance.POSITION))
    return provenance.attach_source(vectors, texts).select(
        "dataset", "split", *_long("shard_id"), "original_index", "text",
        F.round(F.get("embeddings", F.lit(0)), DIGITS).alias("x0"),
    )


# Validation


def _checked(spark: SparkSession, sf_dir: str, broken: bool = True) -> DataFrame:
    return validation.validate_files(inputs.vector_tree(spark, sf_dir, broken))


@registered
def validate_files(spark, sf_dir):
    return _checked(spark, sf_dir).select(
        "dataset", "split", "file", "rows", *_long("dim", "min_dim", "max_dim", "nan_n", "inf_n"), "valid",
        F.array_join("errors", "; ").alias("errors"), F.array_join("warnings", "; ").alias("warnings"),
    )


def _tree(spark: SparkSession, sf_dir: str) -> tuple[str, Callable[[], None]]:
    """A tree of good, odd and empty files, and what adds files without vectors to it."""
    root = fresh_path(spark, "tree")
    kept = ["embeddings", "original_index"]
    good = inputs.vector_tree(spark, sf_dir).select(*kept)
    good.write.parquet(f"{root}/good/s0")
    inputs.vector_tree(spark, sf_dir, broken=True).select(*kept).write.parquet(f"{root}/odd/s0")
    good.filter("false").write.parquet(f"{root}/empty/s0")
    return root, lambda: good.select("original_index").write.parquet(f"{root}/bare/s0")


def _told(files: DataFrame) -> DataFrame:
    return files.groupBy("dataset", "split").agg(
        F.sum("rows").alias("rows"), *[F.sum(c).cast("long").alias(c) for c in ("nan_n", "inf_n")],
        F.bool_and("valid").alias("valid"), F.array_join(F.array_sort(F.collect_set(F.get("errors", F.lit(0)))), "; ").alias("errors"),
        F.bool_or(F.size("warnings") > 0).alias("warned"),
    )


@registered
def validate_tree(spark, sf_dir):
    root, add = _tree(spark, sf_dir)
    add()
    return _told(embedding_run.validate_tree(spark, root))


@registered
def validate_changed(spark, sf_dir):
    """The same tree, of which a part was checked before the rest was there."""
    root, add = _tree(spark, sf_dir)
    known = stored(embedding_run.validate_changed(spark, root), "known")
    add()
    return _told(embedding_run.validate_changed(spark, root, known))


@registered
def validate_rollup(spark, sf_dir):
    return validation.report(_checked(spark, sf_dir)).select(
        *_shown("dataset", "split"), "level", "samples", "files", *_rounded("size_mb"), "invalid"
    )


@registered
def validate_overall(spark, sf_dir):
    total = validation.overall(_checked(spark, sf_dir))
    return total.withColumn("dims", F.array_join(F.col("dims").cast("array<string>"), ","))


@registered
def validation_issues(spark, sf_dir):
    return validation.issues(_checked(spark, sf_dir))


@registered
def split_dims(spark, sf_dir):
    return validation.split_dims(_checked(spark, sf_dir)).select("dataset", "split", *_long("dim"))


@registered
def size_labels(spark, sf_dir):
    sized = validation.report(_checked(spark, sf_dir, broken=False))
    return sized.select(*_shown("dataset", "split"), size_label(F.col("size_mb")).alias("label"))


@registered
def compare_source(spark, sf_dir):
    rows = inputs.samples(spark, sf_dir)
    labelled = rows.join(inputs.table(spark, sf_dir, "labels"), "doc_id", "left_semi")
    embedded = catalog.split_counts(labelled).withColumnRenamed("n", "embedded")
    source = catalog.split_counts(rows).filter("dataset <> 'src1'").withColumnRenamed("n", "source")
    return validation.compare_source(embedded, source).select(
        "dataset", "split", "embedded",
        *[F.coalesce(c, F.lit(-1)).cast("long").alias(c) for c in ("source", "diff")],
        F.round(F.coalesce("pct", F.lit(-1.0)), DIGITS).alias("pct"),
        F.coalesce("matches", F.lit(False)).alias("matches"),
    )


@registered
def vector_stats(spark, sf_dir):
    rows = inputs.vector_tree(spark, sf_dir)
    return validation.vector_stats(rows, ["original_index"]).select(
        "original_index", *_long("dim"), *_rounded("min", "max", "mean", "std", "norm")
    )


@registered
def sample_vectors(spark, sf_dir):
    rows = inputs.vector_tree(spark, sf_dir)
    found = validation.sample_vectors(rows, validation.validate_files(rows))
    return found.select(
        "file", "original_index", *_rounded("norm"), F.posexplode("head").alias("component", "x")
    ).select("file", "original_index", "norm", *_long("component"), *_rounded("x"))


@registered
def set_metadata(spark, sf_dir):
    found = provenance.set_metadata(inputs.vector_tree(spark, sf_dir))
    return found.select(
        "total", *_long("dim"), F.array_join("splits", ",").alias("splits"), F.array_join("datasets", ",").alias("datasets")
    )


# Neighbours and layout


@registered
def knn_graph(spark, sf_dir):
    found = neighbors.knn_graph(inputs.table(spark, sf_dir, "embeddings"), "vec_id", "embedding", k=15, block_rows=BLOCK_ROWS)
    return found.select("i", "j", *_long("rk"), "d")


@registered
def knn_text_ids(spark, sf_dir):
    """The graph between documents that have a vector, by names that sort as text."""
    named = inputs.table(spark, sf_dir, "embeddings").select(F.concat(F.lit("v"), "vec_id").alias("name"), "embedding")
    found = neighbors.knn_graph(named, "name", "embedding", k=5, block_rows=BLOCK_ROWS)
    return found.select("i", "j", *_long("rk"), "d")


@registered
def knn_descent(spark, sf_dir):
    return _descent(spark, sf_dir).select("i", "j", *_long("rk"), "d")


def _descent(spark, sf_dir):
    return neighbors.knn_descent(inputs.table(spark, sf_dir, "embeddings"), "vec_id", "embedding", k=15, block_rows=BLOCK_ROWS)


@registered
def descent_recall(spark, sf_dir):
    """Whether the descent finds nine tenths of the exact neighbours."""
    exact = neighbors.knn_graph(inputs.table(spark, sf_dir, "embeddings"), "vec_id", "embedding", k=15, block_rows=BLOCK_ROWS)
    hits = exact.join(_descent(spark, sf_dir).select("i", "j", F.lit(1).alias("hit")), ["i", "j"], "left")
    return hits.agg(F.count("*").alias("n_pairs"), (F.count("hit") >= 0.9 * F.count("*")).alias("found"))


@registered
def fuzzy_graph(spark, sf_dir):
    found = neighbors.fuzzy_graph(inputs.table(spark, sf_dir, "embeddings"), "vec_id", "embedding", n_neighbors=15, block_rows=BLOCK_ROWS)
    return found.select("i", "j", F.round("w", 5).alias("w"))


@registered
def pca_2d(spark, sf_dir):
    found = projection.pca_2d(inputs.table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return found.select("vec_id", F.round("x", 5).alias("x"), F.round("y", 5).alias("y"))


def _described(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = inputs.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("vec_id"), "text")
    named = inputs.vector_tree(spark, sf_dir).select(F.col("original_index").alias("vec_id"), "dataset", "split")
    return named.join(texts, "vec_id", "left").withColumn("text", F.coalesce("text", F.lit("-")))


@registered
def plot_points(spark, sf_dir):
    return projection.point_table(pca_2d(spark, sf_dir), _described(spark, sf_dir), ["vec_id"])


@registered
def layout_2d(spark, sf_dir):
    vectors = inputs.table(spark, sf_dir, "embeddings")
    positions = projection.layout_2d(vectors, "vec_id", "embedding", block_rows=BLOCK_ROWS)
    return projection.point_table(positions, _described(spark, sf_dir), ["vec_id"])


@registered
def layout_step(spark, sf_dir):
    """One epoch from places that both engines know."""
    at = inputs.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("v"), *[(F.get("embedding", F.lit(i)).cast("double") * 10).alias(c) for i, c in enumerate("xy")]
    )
    found = projection.layout_step(at, fuzzy_graph(spark, sf_dir), STEP_EPOCH)
    return found.select("v", F.round("x", 5).alias("x"), F.round("y", 5).alias("y"))


@registered
def legend(spark, sf_dir):
    slots = provenance.legend(inputs.vector_tree(spark, sf_dir))
    return slots.select("split", *_long("slot"), "n")


@registered
def legend_slots(spark, sf_dir):
    rows = inputs.vector_tree(spark, sf_dir).select("original_index", "split")
    return provenance.with_slots(rows).select("original_index", "split", *_long("slot"))


# Layout blocks


@registered
def block_records(spark, sf_dir):
    found = blocks.records(inputs.blocks(spark, sf_dir))
    return found.select(
        "document", *_long("page", "block_id"), "type", "text",
        *[F.round(f"bbox_normalized.{c}", DIGITS).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")],
        *[F.col(f"bbox_pixels.{c}").cast("long").alias(c) for c in ("x0", "y0", "x1", "y1")],
        "is_valid",
    )


@registered
def block_preview(spark, sf_dir):
    found = blocks.preview(inputs.blocks(spark, sf_dir))
    parsed = found.withColumn("box", F.from_json("bbox", BBOX.simpleString()))
    return parsed.select("document", *_long("page", "id"), "type", "text", "box.*")


@registered
def drawable_blocks(spark, sf_dir):
    found = blocks.drawable(inputs.blocks(spark, sf_dir))
    return found.select("document", *_long("page", "block_id"), *_rounded("x0", "y0", "x1", "y1"), "label")


@registered
def block_classes(spark, sf_dir):
    """Blocks with the size of their class, two classes being unknown."""
    found = inputs.blocks(spark, sf_dir)
    classes = found.groupBy(F.coalesce("type", F.lit("DEFAULT")).alias("type")).agg(F.count(F.lit(1)).alias("class_n"))
    known = classes.filter("type NOT IN ('TOC', 'Footnote')")
    return blocks.with_class(found, known).select("document", *_long("page", "block_id"), *_shown("type"), "class_n")


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = inputs.blocks(spark, sf_dir).filter("page % 11 <> 0")
    results = blocks.page_results(inputs.parsed_pages(spark, sf_dir), kept)
    empty = inputs.parsed_pages(spark, sf_dir).select(F.concat("document", F.lit("-empty")).alias("document"))
    return blocks.document_results(results, empty.unionByName(inputs.parsed_pages(spark, sf_dir).select("document")))


@registered
def parse_docs(spark, sf_dir):
    return _parsed(spark, sf_dir)


@registered
def parse_totals(spark, sf_dir):
    return blocks.run_totals(_parsed(spark, sf_dir))


@registered
def decode_responses(spark, sf_dir):
    found = responses.decode(inputs.responses(spark, sf_dir))
    return found.select("page", *_long("block_id"), "type", "text", F.round("bbox.xmin", DIGITS).alias("xmin"))


@registered
def archive_elements(spark, sf_dir):
    found = blocks.element_counts(archives.elements(inputs.archives(spark, sf_dir)).filter("ok"))
    return found.select("document", *_long("elements", "text_n", "table_n"))


def _zips(spark: SparkSession, sf_dir: str) -> str:
    return inputs.saved(inputs.archives(spark, sf_dir).select(F.concat("document", F.lit(".zip")).alias("path"), "content"), "zips")


def _counted(structured: DataFrame) -> DataFrame:
    found = blocks.element_counts(archives.parsed(structured).filter("ok"))
    return found.select("document", *_long("elements", "text_n", "table_n"))


@registered
def read_archives(spark, sf_dir):
    """ZIP files with their contents in a column."""
    return _counted(archives.structured_json(archives.read_archives(spark, _zips(spark, sf_dir))))


@registered
def read_structured(spark, sf_dir):
    """ZIP files of which only one member is read."""
    return _counted(archives.read_structured(spark, _zips(spark, sf_dir), bytes_per_task=100_000))


@registered
def read_block_pages(spark, sf_dir):
    """A JSON list for each page, in a folder for each document."""
    records = blocks.records(inputs.blocks(spark, sf_dir))
    record = F.struct([c for c in records.columns if c != "document"])
    pages = records.groupBy("document", "page").agg(F.to_json(F.sort_array(F.collect_list(record))).alias("content"))
    root = inputs.saved(pages.select(F.concat_ws("", "document", F.lit("/page_"), "page", F.lit(".json")).alias("path"), "content"), "pages")
    found = sources.read_block_pages(spark, root).groupBy("document", "page")
    return found.agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("n_chars")).select("document", *_long("page"), "n", "n_chars")


@registered
def extraction_totals(spark, sf_dir):
    return blocks.extraction_totals(archives.elements(inputs.archives(spark, sf_dir)))


@registered
def layout_records(spark, sf_dir):
    pages = inputs.parsed_pages(spark, sf_dir).withColumn("page", F.col("page").cast("long"))
    replies = pages.join(inputs.responses(spark, sf_dir), "page")
    return layout_run.parse(replies).documents


# Links and fetches


@registered
def decoded_pages(spark, sf_dir):
    """Page bytes with invalid sequences put in."""
    body = F.concat(F.unhex(F.lit("FF")), F.encode("html", "utf-8"), F.unhex(F.lit("C3")))
    pages = inputs.table(spark, sf_dir, "pages").select("page_id", body.alias("body"))
    return pages.select("page_id", decoded(pages, "body").alias("text"))


@registered
def data_uris(spark, sf_dir):
    pages = inputs.table(spark, sf_dir, "pages")
    return pages.select("page_id", data_uri(F.encode("html", "utf-8")).alias("uri"))


@registered
def landing_link(spark, sf_dir):
    return fetch.landing_links(inputs.landing_pages(spark, sf_dir)).select(
        "page_id", *_shown("method", "link", "route")
    )


@registered
def quarantine(spark, sf_dir):
    found = fetch.landing_links(inputs.landing_pages(spark, sf_dir))
    root = fresh_path(spark, "quarantine")
    writers.write_quarantine(found, root)
    return sources.read_pages(spark, root).select("page_id", "url", F.length("html").cast("long").alias("n_chars"))


@registered
def viewer_link(spark, sf_dir):
    return fetch.viewer_links(inputs.viewer_pages(spark, sf_dir)).select("page_id", *_shown("link"))


@registered
def classify_fetch(spark, sf_dir):
    found = fetch.classified(inputs.fetched(spark, sf_dir))
    return found.select("page_id", "url", "first_class", "second_class", "route")


@registered
def fetch_summary(spark, sf_dir):
    found = fetch.classified(inputs.fetched(spark, sf_dir))
    status = (
        F.when(F.col("page_id") % 7 == 0, "skipped").when(F.col("second_class") == "accepted", "downloaded").otherwise("failed")
    )
    size = F.when(status != "failed", F.octet_length("body"))
    summary = fetch.fetch_summary(found.select(status.alias("status"), size.alias("n_bytes")))
    return summary.select("status", "n", *_rounded("mb"))


# Run log


@registered
def run_summary(spark, sf_dir):
    return runlog.status_summary(inputs.run_log(spark, sf_dir)).select("status", "shards", "samples", *_rounded("rate"))


@registered
def run_totals(spark, sf_dir):
    found = runlog.run_totals(inputs.run_log(spark, sf_dir))
    return found.select("run", "shards", "samples", "new_samples", *_rounded("elapsed", "rate"))


@registered
def run_progress(spark, sf_dir):
    found = runlog.progress(inputs.run_log(spark, sf_dir), LOG_ROWS_PER_BUCKET)
    return found.select("run", "event_id", "done", "total_samples", *_rounded("avg_rate"))


@registered
def worker_latest(spark, sf_dir):
    found = runlog.latest(inputs.run_log(spark, sf_dir))
    return found.select("worker", "stage", "filename", "current", "total", *_rounded("pct"))


# Written and read back


@registered
def roundtrip_shards(spark, sf_dir):
    root = fresh_path(spark, "shards")
    rows = inputs.vector_tree(spark, sf_dir).withColumn("shard_id", (F.col("original_index") % 4).cast("int"))
    writers.write_embeddings(rows, root)
    stored = sources.read_shards(spark, root)
    total = F.round(F.sum(F.get("embeddings", F.lit(0))), DIGITS).alias("x0")
    return stored.groupBy("dataset", "split", F.col("shard_id").cast("long").alias("shard_id")).agg(
        F.count(F.lit(1)).alias("n"), total
    )


@registered
def roundtrip_blocks(spark, sf_dir):
    root = fresh_path(spark, "blocks")
    writers.write_blocks(blocks.records(inputs.blocks(spark, sf_dir)), root)
    stored = sources.read_block_table(spark, root)
    return stored.groupBy("document", F.col("page").cast("long").alias("page")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_valid").alias("valid"), F.sum(F.length("text")).alias("n_chars")
    )


@registered
def roundtrip_block_store(spark, sf_dir):
    root = fresh_path(spark, "block-store")
    writers.write_block_store(blocks.records(inputs.blocks(spark, sf_dir)), root, rows_per_file=1000)
    every = sources.read_block_store(spark, root).groupBy("document", "page")
    one = sources.read_block_store(spark, root, "src1").agg(F.count("*").alias("n_src1"))
    found = every.agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("n_chars"))
    return found.select("document", *_long("page"), "n", "n_chars").join(F.broadcast(one))


@registered
def roundtrip_preview(spark, sf_dir):
    root = fresh_path(spark, "preview")
    writers.write_preview(inputs.blocks(spark, sf_dir), root)
    schema = "document string, page long, id long, type string, text string, bbox string"
    stored = spark.read.schema(schema).csv(root, sep="\t", header=True, escape='"')
    return stored.groupBy("document", "page").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length(F.coalesce("text", F.lit("")))).alias("n_chars")
    )


@registered
def roundtrip_structured(spark, sf_dir):
    root = fresh_path(spark, "structured")
    writers.write_structured(archives.structured_json(inputs.archives(spark, sf_dir)), root)
    elements = F.json_array_length(F.get_json_object("value", "$.data.elements")).cast("long")
    return spark.read.text(root).select(
        F.get_json_object("value", "$.document").alias("document"), elements.alias("elements")
    )


@registered
def roundtrip_points(spark, sf_dir):
    root = fresh_path(spark, "points")
    writers.write_points(plot_points(spark, sf_dir), root)
    return spark.read.parquet(root).groupBy("dataset", "split").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("x"), 5).alias("x"), F.sum(F.length("text")).alias("n_chars")
    )


def _json_round_trip(spark: SparkSession, sf_dir: str, read: Callable[[str], DataFrame]) -> DataFrame:
    root = fresh_path(spark, "embedding-json")
    texts = inputs.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("original_index"), "text")
    kept = F.when(F.col("original_index") % 6 != 0, F.col("embeddings"))
    rows = inputs.vector_tree(spark, sf_dir).withColumn("embedding", kept).join(texts, "original_index", "left")
    rows = rows.withColumns({"shard_id": F.col("original_index") % 4, "original_index": F.expr("original_index div 4")})
    metadata = F.struct(F.lit("token-hash").alias("model"), F.lit(16).alias("embedding_dimension"))
    writers.write_embedding_json(rows, root, metadata, ITEMS_PER_OBJECT)
    first = F.from_json(F.get_json_object("value", "$.embeddings[0]"), "dataset string, split string")
    items = F.json_array_length(F.get_json_object("value", "$.embeddings")).cast("long")
    objects = spark.read.text(root).select(first.alias("f"), items.alias("items")).groupBy("f.dataset", "f.split")
    objects = objects.agg(F.count(F.lit(1)).alias("objects"), F.max("items").alias("largest"))
    return read(root).groupBy("dataset", "split").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.length("text")).alias("n_chars"),
        F.round(F.sum(F.get("embedding", F.lit(1))), DIGITS).alias("x1"),
    ).join(objects, ["dataset", "split"])


@registered
def roundtrip_json(spark, sf_dir):
    return _json_round_trip(spark, sf_dir, lambda root: sources.read_embedding_json(spark, root, multi_line=False))


@registered
def roundtrip_large_json(spark, sf_dir):
    """The same files by byte ranges, which objects and items cross."""
    return _json_round_trip(spark, sf_dir, lambda root: large_json.read_large_embedding_json(spark, root, 1 << 16))


# Streams


def _arriving(spark: SparkSession, sf_dir: str, name: str, key: str, consume: Callable[[str, int], None]) -> None:
    """A table that arrives in two parts of several files; ``consume`` runs after each, in batches of half their files."""
    root = fresh_path(spark, f"arriving-{name}")
    rows = inputs.table(spark, sf_dir, name)
    half = 1 + rows.count() // (4 * ROWS_PER_ARRIVING_FILE)
    for part in (0, 1):
        rows.filter(F.pmod(F.xxhash64(key), F.lit(2)) == part).repartition(2 * half).write.mode("append").parquet(root)
        consume(root, half)


@registered
def stream_embed(spark, sf_dir):
    schema = inputs.table(spark, sf_dir, "documents").schema
    out, checkpoint = fresh_path(spark, "stream-embed"), fresh_path(spark, "stream-embed-state")

    def consume(root: str, files: int) -> None:
        docs = jobs.file_stream(spark, root, schema, files_per_batch=files)
        jobs.run(lambda: jobs.embed_new_files(docs, out, checkpoint, ["doc_id"]))

    _arriving(spark, sf_dir, "documents", "doc_id", consume)
    return _components(spark.read.parquet(out), "doc_id")


def _streamed_log(spark: SparkSession, sf_dir: str, start: Callable, name: str) -> DataFrame:
    schema = inputs.table(spark, sf_dir, "events").schema
    out, checkpoint = fresh_path(spark, name), fresh_path(spark, f"{name}-state")

    def consume(root: str, files: int) -> None:
        log = inputs.as_run_log(jobs.file_stream(spark, root, schema, files_per_batch=files))
        jobs.run(lambda: start(log, out, checkpoint))

    _arriving(spark, sf_dir, "events", "event_id", consume)
    return jobs.latest_batch(spark, out)


@registered
def stream_totals(spark, sf_dir):
    return _streamed_log(spark, sf_dir, jobs.stream_totals, "stream-totals")


@registered
def stream_latest(spark, sf_dir):
    found = _streamed_log(spark, sf_dir, jobs.stream_latest, "stream-latest")
    return found.select("worker", "stage", "filename", "current", "total", *_rounded("pct"))
