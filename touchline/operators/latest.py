"""One row per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each group in a total order.

    All other columns follow ``order``, so rows that tie in it do not depend on the order of the input.

    Written as rank-then-filter, which Spark plans with a group limit on both sides of the
    exchange: each map task ships at most one row per group, so a group that holds a large
    share of the table is cut down before it is shuffled.
    """
    rest = [
        F.col(f.name).asc_nulls_last()
        for f in df.schema.fields
        if f.name not in keys and isinstance(f.dataType, T.AtomicType)
    ]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, *rest))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")
