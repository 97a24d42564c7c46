"""Places of rows in a global order, without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import written


def ranked(df: DataFrame, group: str, order: list[str | Column], folder: str, name: str) -> DataFrame:
    """``df`` with ``rank`` (place in its group by ``order``, from 0) and ``total`` (rows of the group).

    Rows are dealt by ranges of (group, order) and sorted there, so a group of any size is spread over many tasks.
    A row's place is its place in the task plus the rows of its group in earlier tasks; only these counts, one
    per task and group, meet. The sorted rows are written once, so places do not change when a task
    is run again. ``order`` is to tell all rows of a group apart; null groups are one group.
    """
    keys = [F.col(group), *order]
    lined = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    lined = written(lined.withColumn("_at", F.monotonically_increasing_id()), folder, name)
    part = F.shiftright("_at", 33)
    runs = lined.groupBy(F.col(group).alias("_group"), part.alias("_part")).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    of_group = Window.partitionBy("_group")
    earlier = of_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "_group", "_part", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(of_group).alias("total"))
    placed = lined.withColumn("_part", part).join(
        runs.withColumnRenamed("_part", "_in"), (F.col("_part") == F.col("_in")) & F.col(group).eqNullSafe(F.col("_group")))
    return placed.select(
        *df.columns, (F.col("_at") - F.col("_first") + F.col("_before")).alias("rank"), "total")
