"""Equi-join that spreads hot keys."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAIRS_PER_CELL = 1_000_000


def _weights(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def spread_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    pairs_per_cell: int = PAIRS_PER_CELL,
    keep: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """Inner equi-join on ``keys``; every pair of a key appears exactly once.

    Size-based skew handling does not see a key whose rows are few but whose pairs are many.
    The pairs per key are therefore counted first, from one pre-aggregated row per key and side.
    A key with more pairs than ``pairs_per_cell`` is cut into slices of the square root of that
    number of rows: each left row goes to one left slice and is repeated for every right slice,
    and the other way round, so a pair meets in exactly one cell of the grid and the cells run on
    different tasks. That shape repeats the fewest rows; a short side is not cut at all. All other
    keys keep one cell and are not repeated.

    Slices are chosen by a hash of the row, which a lost task repeats in the same way. Rows should
    therefore be distinct; equal rows stay together.

    ``keep`` may write the list of hot keys. It is empty or short as a rule; once it is at rest
    the planner sees its size, broadcasts it below the session's limit and shuffles otherwise.
    """
    sizes = (
        _weights(left, keys, "_nl")
        .join(_weights(right, keys, "_nr"), list(keys))
        .filter(F.col("_nl").cast("double") * F.col("_nr") > pairs_per_cell)
    )
    slice_rows = float(pairs_per_cell) ** 0.5
    hot = keep(
        sizes.select(
            *keys,
            F.ceil(F.col("_nl") / slice_rows).cast("int").alias("_cuts_l"),
            F.ceil(F.col("_nr") / slice_rows).cast("int").alias("_cuts_r"),
        )
    )

    def cut(df: DataFrame, own: str, other: str) -> DataFrame:
        row_hash = F.xxhash64(*[F.col(c) for c in df.columns])
        return (
            df.join(hot, list(keys), "left")
            .withColumn(f"_cut_{own}", F.pmod(row_hash, F.coalesce(f"_cuts_{own}", F.lit(1))).cast("int"))
            .withColumn(
                f"_cut_{other}",
                F.explode(F.sequence(F.lit(0), F.coalesce(f"_cuts_{other}", F.lit(1)) - 1)),
            )
            .drop("_cuts_l", "_cuts_r")
        )

    joined = cut(left, "l", "r").join(cut(right, "r", "l"), [*keys, "_cut_l", "_cut_r"])
    return joined.drop("_cut_l", "_cut_r")
