"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks. Clusters bring their own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("corpusflow")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def workspace(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session, where driver and
    executors share one disk, may fall back to a temporary folder.
    """
    sc = spark.sparkContext
    base = sc.getConf().get(_CHECKPOINT_DIR) or sc.getCheckpointDir()
    if base is None:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"set {_CHECKPOINT_DIR} to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="corpusflow-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{workspace(spark)}/{name}-{uuid.uuid4().hex}"


#: Bytes of a row group where a row holds many vectors: a reader takes up to a whole group at once.
LONG_ROWS = 16 * 1024 * 1024


def stored(df: DataFrame, name: str = "table", group_bytes: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, on request in row groups of so many bytes.

    Cuts the lineage, fixes rows that several later jobs use, and survives lost executors.
    """
    path = fresh_path(df.sparkSession, name)
    writer = df.write if group_bytes is None else df.write.option("parquet.block.size", group_bytes)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes that opening a small file counts as.
OPEN_BYTES = 64 * 1024
#: Tasks for each core that list folders.
LISTING_WAVES = 2
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def small_files(spark: SparkSession) -> SparkSession:
    """A session with the settings of ``spark``, for readers of many small files.

    Opening a file counts as 4 MB by default, so that a task gets 32 files at most, however small
    they are, and tasks grow with the files. Folders are listed by one task each by default, up to
    10,000: here a task lists many.
    """
    session = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            session.conf.set(name, value)
    cost = session.conf.get("spark.sql.files.openCostInBytes")
    if not cost.isdigit() or int(cost) > OPEN_BYTES:  # a figure with a unit is replaced
        session.conf.set("spark.sql.files.openCostInBytes", str(OPEN_BYTES))
    waves = LISTING_WAVES * spark.sparkContext.defaultParallelism
    session.conf.set(_LISTING, str(min(int(session.conf.get(_LISTING)), waves)))
    return session


def checkpointed(df: DataFrame, path: str | None = None) -> DataFrame:
    """Checkpoint of an iteration's state: written to ``path``, in place of what is there, or to a new folder.

    Spark's own checkpoints keep the size that was estimated from the plan. A join's is the product of
    both sides, so its digits double with every turn and a plan soon takes minutes; files have their true size.
    """
    path = path or fresh_path(df.sparkSession, "checkpoint")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession, root: Path, packages: Sequence[str]) -> None:
    """Send packages below ``root`` to the Python workers, once per Spark application."""
    sc = spark.sparkContext
    name = f"{packages[0]}-{sc.applicationId}.zip"
    if any(path.endswith(name) for path in sc.listFiles):
        return
    bundle = Path(tempfile.mkdtemp(prefix="corpusflow-")) / name  # Spark copies it to the executors
    with zipfile.ZipFile(bundle, "w") as archive:
        for package in packages:
            for source in sorted((root / package).rglob("*.py")):
                archive.write(source, source.relative_to(root))
    sc.addPyFile(str(bundle))
