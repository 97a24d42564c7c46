"""Session settings that the plans rely on, and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# All of these can be changed on a running session.
_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A join on player and season may use rows that are already partitioned by player.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Page bodies are large: a batch for Python is bounded by bytes and not by rows alone.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
}


_OWN_FOLDERS: dict[str, str] = {}
# Folders taken since each open ``run_folders`` began.
_RUNS: list[list[str]] = []


# Bytes of compressed columns that a task reads: as rows of text they take ten times as much and more, and a task sorts them.
_SCAN_BYTES = 16 * 1024 * 1024
# A file of a written relation is read by one task where it is a single row group.
FILE_ROWS = 1_000_000
# Relations of a warehouse are written with this compression.
CODEC = "zstd"


def small_scans(spark: SparkSession) -> None:
    """Deal scans to tasks that can sort what they read in memory, however large the files are."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(_SCAN_BYTES))


def free_shuffles(spark: SparkSession) -> None:
    """Remove the shuffle files of a query when it ends. Else they lie there until the driver's memory is cleaned up: a run
    that writes its intermediates would have the files of all its steps on disk at once. A relation that is executed a
    second time shuffles again."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def tune(spark: SparkSession) -> SparkSession:
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8, **settings: str) -> SparkSession:
    """A session on one machine, for tests and benchmarks; its shared folder is a temporary one."""
    settings.setdefault("spark.checkpoint.dir", tempfile.mkdtemp(prefix="touchline-"))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("touchline")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """A new folder under the checkpoint folder that the cluster names; all executors share it.

    A cluster must name one. A local session that does not gets one temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = _OWN_FOLDERS.setdefault(context.applicationId, "") or tempfile.mkdtemp(prefix="touchline-")
        _OWN_FOLDERS[context.applicationId] = root
    folder = f"{root.rstrip('/')}/touchline-{uuid.uuid4().hex}"
    for run in _RUNS:
        run.append(folder)
    return folder


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder through the file system that it is in."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


@contextmanager
def run_folders(spark: SparkSession) -> Iterator[None]:
    """Remove at the end all shared folders that were taken inside; relations that read them are to be written by then.

        with run_folders(spark):
            operator(docs).write.parquet(target)
    """
    run: list[str] = []
    _RUNS.append(run)
    try:
        yield
    finally:
        _RUNS.remove(run)
        for folder in run:
            remove_folder(spark, folder)


def written(df: DataFrame, folder: str, name: str, file_rows: int = 0, codec: str | None = None) -> DataFrame:
    """Write a relation that has several readers and read it back: cuts the lineage, survives
    lost executors, and later scans read only the columns they need. ``file_rows`` bounds the rows of a file; ``codec``
    names a compression (keys in hex take half the bytes with ``zstd``), else it is the session's."""
    path = f"{folder}/{name}"
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", file_rows)
    (writer.option("compression", codec) if codec else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
