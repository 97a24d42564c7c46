"""Splitting records into valid and rejected ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.schemas import required_columns


def with_reject_reason(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Name the required columns a record lacks in ``reject_reason``; NULL for valid records."""
    missing = F.array_compact(
        F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required_columns(schema)])
    )
    return df.withColumn(
        "reject_reason",
        F.when(F.size(missing) > 0, F.concat(F.lit("missing "), F.array_join(missing, ", "))),
    )


def split_records(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected). Both are filters over the same input, nothing is dropped in between."""
    judged = with_reject_reason(df, schema)
    valid = judged.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return valid, judged.filter(F.col("reject_reason").isNotNull())
