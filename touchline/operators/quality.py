"""Data tests. A test is a relation of failing rows; no rows, no failure."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.text import safe_ratio


@dataclass(frozen=True)
class DataTest:
    """One test of one column. ``options`` hold the parameters of its kind."""

    model: str
    column: str
    kind: str
    options: Mapping = field(default_factory=dict)

    @property
    def name(self) -> str:
        return f"{self.kind}__{self.model}__{self.column}"


def is_missing(column: str) -> Column:
    return F.col(column).isNull()


def is_not_accepted(column: str, values: Sequence) -> Column:
    return F.col(column).isNotNull() & ~F.col(column).isin(list(values))


def is_out_of_range(
    column: str, min_value=None, max_value=None, inclusive: bool = True, where: str | None = None
) -> Column:
    """NULL is in range. ``where`` narrows the rows that are looked at."""
    value = F.col(column)
    bad = F.lit(False)
    if min_value is not None:
        bad = bad | (value < min_value if inclusive else value <= min_value)
    if max_value is not None:
        bad = bad | (value > max_value if inclusive else value >= max_value)
    return F.coalesce(bad & F.expr(where) if where else bad, F.lit(False))


def is_ratio_above(column: str, per: str, limit: float = 1.0) -> Column:
    ratio = safe_ratio(F.col(column), F.col(per))
    return F.coalesce((F.col(per) > 0) & (ratio > limit), F.lit(False))


_ROW_TESTS = {
    "not_null": lambda t: is_missing(t.column),
    "accepted_values": lambda t: is_not_accepted(t.column, t.options["values"]),
    "accepted_range": lambda t: is_out_of_range(t.column, **t.options),
    "xg_per_shot_range": lambda t: is_ratio_above(t.column, t.options["shots_column"]),
}


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """Values that stand more than once; pre-aggregated, so a hot value is one row per task."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Distinct child keys without a parent. Keys are made distinct before the join, so a hot
    key costs one row per task; NULL keys are not looked at."""
    keys = child.select(column).dropna().distinct()
    known = parent.select(F.col(parent_column).alias(column))
    return keys.join(known, column, "left_anti")


def orphan_rows(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """The failing child rows themselves."""
    known = parent.select(F.col(parent_column).alias(column))
    return child.filter(F.col(column).isNotNull()).join(known, column, "left_anti")


def failing_rows(test: DataTest, tables: Mapping[str, DataFrame]) -> DataFrame:
    df = tables[test.model]
    if test.kind in _ROW_TESTS:
        return df.filter(_ROW_TESTS[test.kind](test))
    if test.kind == "unique":
        return duplicates(df, test.column)
    if test.kind == "relationships":
        return orphan_rows(df, test.column, tables[test.options["to"]], test.options["field"])
    raise ValueError(f"unknown kind of test: {test.kind}")


def _row_test_counts(df: DataFrame, tests: Sequence[DataTest]) -> DataFrame:
    """All row tests of a relation in one scan: one counter per test, then one row per test."""
    counters = [
        F.count_if(_ROW_TESTS[t.kind](t)).alias(f"c{i}") for i, t in enumerate(tests)
    ]
    return df.agg(*counters).select(F.inline(F.array(*_labelled(tests))))


def _labelled(tests: list[DataTest]) -> list[Column]:
    return [
        F.struct(
            F.lit(t.model).alias("model"), F.lit(t.column).alias("column"),
            F.lit(t.kind).alias("test"), F.col(f"c{i}").alias("failures"),
        )
        for i, t in enumerate(tests)
    ]


def _hash(c: Column, kind: str) -> Column:
    # Both zeros are one value to a group, but not to a hash.
    return F.xxhash64(c + F.lit(0.0).cast(kind) if kind in ("double", "float") else c)


Keep = Callable[[DataFrame, str], DataFrame]


def as_is(df: DataFrame, name: str) -> DataFrame:
    return df


def _unique_test_counts(df: DataFrame, tests: list[DataTest], keep: Keep = as_is) -> DataFrame:
    """Values that stand more than once, for all uniqueness tests of a relation.

    A first pass counts 64-bit hashes: of a key that is unique, eight bytes move and not the value. Only rows whose
    hash was met twice are grouped by the value itself, so a chance meeting of two hashes is no failure; on clean data
    there are none. ``keep`` may write these hashes: once they are at rest the planner sees that they are few and moves no
    value to find that out. Where they are many, values move once: by their hash, which the groups begin with.
    """
    kinds = dict(df.dtypes)
    hashes = F.array(*[
        F.when(F.col(t.column).isNotNull(), F.struct(F.lit(i).alias("i"), _hash(F.col(t.column), kinds[t.column]).alias("h")))
        for i, t in enumerate(tests)
    ])
    met = df.select(F.inline(F.array_compact(hashes))).groupBy("i", "h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = keep(met.select("i", "h"), f"{tests[0].model}__met_twice")
    parts = []
    for i, t in enumerate(tests):
        suspects = met.filter(F.col("i") == i).select("h")
        rows = df.select(F.col(t.column).alias("v")).filter("v is not null")
        again = rows.withColumn("h", _hash(F.col("v"), kinds[t.column])).join(suspects, "h", "left_semi")
        twice = again.groupBy("h", "v").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        parts.append(twice.agg(F.count(F.lit(1)).alias("c0")).select(F.inline(F.array(*_labelled([t])))))
    return reduce(DataFrame.union, parts)


def _reference_test_counts(df: DataFrame, tests: list[DataTest], tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows without a parent, for all reference tests of a relation, from one pass over it.

    The tested columns become (test, value) rows, which are counted with map-side combining: a child has few
    values for its rows. Only these counts meet the parents.
    """
    values = F.array(*[
        F.struct(F.lit(i).alias("i"), F.col(t.column).cast("string").alias("v")) for i, t in enumerate(tests)
    ])
    per_key = df.select(F.inline(values)).filter("v is not null").groupBy("i", "v").agg(F.count(F.lit(1)).alias("n"))
    parents = [
        tables[t.options["to"]].select(F.lit(i).alias("i"), F.col(t.options["field"]).cast("string").alias("v"))
        for i, t in enumerate(tests)
    ]
    orphaned = per_key.join(reduce(DataFrame.union, parents), ["i", "v"], "left_anti")
    counters = [
        F.coalesce(F.sum(F.when(F.col("i") == i, F.col("n"))), F.lit(0)).cast("long").alias(f"c{i}")
        for i, _ in enumerate(tests)
    ]
    return orphaned.agg(*counters).select(F.inline(F.array(*_labelled(tests))))


def run_data_tests(tests: Sequence[DataTest], tables: Mapping[str, DataFrame], keep: Keep = as_is) -> DataFrame:
    """model, column, test, failures, passed – one row per test.

    Row tests of a relation share one scan, and so do its tests of keys. ``keep(df, name)`` may write a relation that
    others are planned by, see ``_unique_test_counts``.
    """
    parts = []
    for model in dict.fromkeys(t.model for t in tests):
        own = [t for t in tests if t.model == model]
        row_tests = [t for t in own if t.kind in _ROW_TESTS]
        if row_tests:
            parts.append(_row_test_counts(tables[model], row_tests))
        unique = [t for t in own if t.kind == "unique"]
        if unique:
            parts.append(_unique_test_counts(tables[model], unique, keep))
        references = [t for t in own if t.kind == "relationships"]
        if references:
            parts.append(_reference_test_counts(tables[model], references, tables))
    return reduce(DataFrame.unionByName, parts).withColumn("passed", F.col("failures") == 0)
