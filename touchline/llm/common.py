"""What the operators of this package share: tables, written intermediates, texts as byte arrays, components."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import touchline
from touchline import session
from touchline.session import written

__all__ = [
    "CHUNK_BYTES", "byte_chunks", "components", "id_arrays", "new_name", "one_per_id", "ragged", "shared_folder", "table",
    "written",
]

# Texts are turned into numpy arrays in groups of about this many bytes; a longer text is a group of its own.
CHUNK_BYTES = 1 << 20
# Batches for Python are bounded by rows and bytes: texts are large, and several workers share an executor.
_BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application: they need not have it installed.

    Also bounds the batches of the session for workers in Python.
    """
    for key, value in _BATCHES.items():
        spark.conf.set(key, value)
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = Path(touchline.__file__).parent
        archive = Path(tempfile.mkdtemp(prefix="touchline-")) / "touchline_package.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(root.rglob("*.py")):
                out.write(path, path.relative_to(root.parent))
        context.addPyFile(str(archive))
        _SHIPPED.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """A new folder that all executors share."""
    ship(spark)
    return session.shared_folder(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_name(df: DataFrame, name: str) -> str:
    """``name``, or with more underscores where a column has it already."""
    while name in df.columns:
        name += "_"
    return name


def one_per_id(df: DataFrame, key: str, *values: str) -> DataFrame:
    """``key`` and ``values``, one row per key.

    Keys are unique as a rule, which a pass over the key column alone confirms. If one is repeated, its
    row with the greatest values counts (null is least). All null keys are one key.
    """
    ship(df.sparkSession)
    rows = df.select(key, *values)
    if rows.groupBy(key).count().filter("count > 1").isEmpty():
        return rows
    top = rows.groupBy(key).agg(F.max(F.struct(*values)).alias("_top"))
    return top.select(key, *[F.col(f"_top.{v}").alias(v) for v in values])


def byte_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of groups of whole values; null is an empty value."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + limit, "right")) - 1)
        yield lo, hi, raw[ends[lo] : ends[hi]], ends[lo : hi + 1] - ends[lo]
        lo = hi


def id_arrays(column: pa.Array) -> np.ndarray:
    """An integer column as int64; null is the least number."""
    return column.cast(pa.int64()).fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices of all given ranges, one range after the other."""
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def components(edges: DataFrame, folder: str) -> DataFrame:
    """Connected components of the undirected edges (a, b): node, component (its least node).

    Alternates the large-star and small-star steps until the edges no longer change. A step is one
    aggregation with map-side combining and one equi-join, whose hot keys the adaptive planner splits;
    each round is written to the shared folder, so neither links nor components pass through the driver.
    """
    now = written(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        folder, "links-0",
    )
    mark = _mark(now)
    turn = 0
    while mark[0]:
        turn += 1
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        now = written(small.union(low.select("a", F.col("m").alias("b"))).distinct(), folder, f"links-{turn}")
        new = _mark(now)
        if new == mark:
            break
        mark = new
    least = now.groupBy("a").agg(F.min("b").alias("component"))
    roots = now.select(F.col("b").alias("a"), F.col("b").alias("component")).distinct()
    return least.select(F.col("a").alias("node"), "component").union(
        roots.join(least.select("a"), "a", "left_anti").select(F.col("a").alias("node"), "component")
    )


def _mark(edges: DataFrame) -> tuple[int, int]:
    """Count and order-free hash of the edges, two numbers to tell whether they changed."""
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("a", "b")).alias("h"),
        F.sum(F.xxhash64("b", "a").bitwiseAND(0xFFFFFFFF)).alias("s"),
    ).first()
    return row["n"], (row["h"] or 0, row["s"] or 0)
