"""Summaries of run logs: ``(run, ts, event_id, worker, shard, status, samples, seconds)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusflow.functions.text import keep_tail, percent
from corpusflow.functions.times import micros, seconds
from corpusflow.operators import ordering

# Fixed value: statuses whose samples count towards the totals.
COUNTED = ("success", "skipped")


def counted_samples() -> Column:
    """Samples of shards that were embedded now or earlier; others add none."""
    return F.when(F.col("status").isin(*COUNTED), F.col("samples")).otherwise(F.lit(0))


def _rate(samples: Column, seconds: Column) -> Column:
    return F.when(seconds > 0, samples / seconds).otherwise(F.lit(0.0))


def shard_rates(log: DataFrame) -> DataFrame:
    return log.withColumn("rate", _rate(F.col("samples"), F.col("seconds")))


def status_summary(log: DataFrame) -> DataFrame:
    """Shards, samples, seconds and samples per second by status and in total."""
    return (
        log.groupBy("status")
        .agg(
            F.count(F.lit(1)).alias("shards"),
            F.sum(counted_samples()).alias("samples"),
            F.sum("seconds").alias("seconds"),
        )
        .rollup("status")
        .agg(
            F.sum("shards").alias("shards"),
            F.sum("samples").alias("samples"),
            F.sum("seconds").alias("seconds"),
        )
        .select(
            F.coalesce("status", F.lit("all")).alias("status"),
            "shards",
            "samples",
            _rate(F.col("samples"), F.col("seconds")).alias("rate"),
        )
    )


def run_totals(log: DataFrame) -> DataFrame:
    """Per run: finished shards, samples with and without skipped ones, elapsed time, speed."""
    done = log.withColumn("_us", micros(log, "ts")).groupBy("run").agg(
        F.count(F.lit(1)).alias("shards"),
        F.sum(counted_samples()).alias("samples"),
        F.sum(F.when(F.col("status") == "success", F.col("samples")).otherwise(0)).alias("new_samples"),
        seconds(F.min("_us"), F.max("_us")).alias("elapsed"),
    )
    return done.withColumn("rate", _rate(F.col("samples"), F.col("elapsed")))


def progress(log: DataFrame, rows_per_bucket: int = ordering.ROWS_PER_BUCKET) -> DataFrame:
    """Running shard count, samples and average speed of each run, in order of completion."""
    sums = {"done": F.lit(1), "total_samples": counted_samples()}
    timed = log.withColumn("_us", micros(log, "ts"))
    summed = ordering.running(
        timed, ["run"], ["_us", "event_id"], sums, rows_per_bucket, group_mins={"_start": F.col("_us")}
    )
    elapsed = seconds(F.col("_start"), F.col("_us"))
    return summed.withColumn("avg_rate", _rate(F.col("total_samples"), elapsed)).drop("_start", "_us")


def latest(log: DataFrame, key: str = "worker") -> DataFrame:
    """Last state of each worker with percent done; a partial aggregate, not a sort."""
    state = F.struct("stage", "filename", "current", "total")
    last = log.groupBy(key).agg(F.max_by(state, F.struct("ts", "event_id")).alias("_s"))
    shown = last.select(key, "_s.*")
    return shown.withColumn("filename", keep_tail(F.col("filename"))).withColumn(
        "pct", percent(F.col("current"), F.col("total"))
    )


def totals_by_status(log: DataFrame) -> DataFrame:
    """The form both the batch and the streaming job use."""
    return log.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.sum(counted_samples()).alias("samples"))
