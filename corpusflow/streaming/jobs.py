"""Structured Streaming forms of embedding, running totals and worker state."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from corpusflow.operators import encode, runlog
from corpusflow.operators.shards import pending
from corpusflow.operators.text_samples import only_with_text, with_text


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, pattern: str = "*.parquet", files_per_batch: int | None = None
) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def embed_new_files(
    samples: DataFrame,
    out: str,
    checkpoint: str,
    key: Sequence[str],
    factory: encode.EncoderFactory | None = None,
    tasks: int | None = None,
) -> StreamingQuery:
    """Embed what arrived since the last run and stop.

    The file sink commits each batch once, so a restart neither repeats nor loses rows. Name
    ``tasks`` where batches are few large files, to spread the rows before encoding.
    """
    texts = only_with_text(with_text(samples, exclude=key, out="_sample_text"), "_sample_text")
    if tasks:
        texts = texts.select(*key, "_sample_text").repartition(tasks)
    vectors = encode.embed(texts, "_sample_text", factory, keep=list(key))
    return (
        vectors.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _merged(spark: SparkSession, changed: DataFrame, key: str, out: str, batch_id: int) -> DataFrame:
    """The rows of ``changed`` and those of the batch before whose key did not change."""
    if batch_id == 0:
        return changed
    schema = T.StructType([*changed.schema.fields, T.StructField("batch", T.LongType())])
    before = spark.read.schema(schema).parquet(_slot(out, batch_id - 1))
    before = before.filter(F.col("batch") == batch_id - 1).drop("batch")
    return changed.unionByName(pending(before, changed, [key]))


def _slot(out: str, batch_id: int) -> str:
    return f"{out}/slot={batch_id % 2}"


def _keep_latest(result: DataFrame, key: str, out: str, checkpoint: str) -> StreamingQuery:
    """Merge what a batch changed into the table of the batch before.

    Tables take turns in two folders, so the one before stays whole until the new one, a single
    file, is in place, and nothing grows with the number of batches. A batch that is repeated
    after a failure finds the table before it and replaces its own.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        table = _merged(batch.sparkSession, batch, key, out, batch_id).withColumn("batch", F.lit(batch_id).cast("long"))
        table.coalesce(1).write.mode("overwrite").parquet(_slot(out, batch_id))

    return (
        result.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(availableNow=True)
        .start()
    )


def stream_totals(log: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Running totals by status; the state holds one row per status."""
    return _keep_latest(runlog.totals_by_status(log), "status", out, checkpoint)


def stream_latest(log: DataFrame, out: str, checkpoint: str, key: str = "worker") -> StreamingQuery:
    """Latest state per worker; the state holds one row per worker."""
    return _keep_latest(runlog.latest(log, key), key, out, checkpoint)


def latest_batch(spark: SparkSession, out: str) -> DataFrame:
    """The table after the last batch of :func:`stream_totals` or :func:`stream_latest`."""
    tables = spark.read.parquet(out)
    last = tables.select(F.max("batch").alias("batch"))
    return tables.join(F.broadcast(last), "batch", "left_semi").drop("batch", "slot")  # a single row


def run(query: Callable[[], StreamingQuery]) -> None:
    """Start a bounded stream and wait for its end."""
    started = query()
    started.awaitTermination()
    if started.exception():
        raise started.exception()
