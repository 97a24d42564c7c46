"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: stands for NULL inside a key.
NULL_MARK = "_dbt_utils_surrogate_key_null_"


def packed(key: Column | str) -> Column:
    """The 16 bytes of a surrogate key, for rows that are shuffled with it: its text does not compress."""
    return F.unhex(key)


def unpacked(key: Column | str) -> Column:
    """The surrogate key again."""
    return F.lower(F.hex(key))


def surrogate_key(*cols: Column | str) -> Column:
    """md5 over the text of the columns joined by '-', NULL replaced by a fixed mark."""
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.md5(F.concat_ws("-", *[F.coalesce(p.cast("string"), F.lit(NULL_MARK)) for p in parts]))
