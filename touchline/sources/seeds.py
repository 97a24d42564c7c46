"""Seeds (small curated CSV files) and constant relations."""

from __future__ import annotations

import csv
from datetime import date
from importlib import resources

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from touchline.schemas import PLAYER_OVERRIDES, TEAM_ALIASES

# Leagues in scope with country and tier.
COMPETITIONS = [
    ("Premier League", "England", 1),
    ("La Liga", "Spain", 1),
    ("Bundesliga", "Germany", 1),
    ("Serie A", "Italy", 1),
    ("Ligue 1", "France", 1),
]
LEAGUES = [name for name, _, _ in COMPETITIONS]

# Seasons in scope with first and last day.
SEASONS = [
    ("2023-2024", date(2023, 8, 1), date(2024, 6, 30)),
    ("2024-2025", date(2024, 8, 1), date(2025, 6, 30)),
    ("2025-2026", date(2025, 8, 1), date(2026, 6, 30)),
]
SEASON_LABELS = [label for label, _, _ in SEASONS]

_COMPETITION_SCHEMA = T.StructType(
    [
        T.StructField("competition_name", T.StringType(), False),
        T.StructField("country", T.StringType(), False),
        T.StructField("tier", T.IntegerType(), False),
    ]
)
_SEASON_SCHEMA = T.StructType(
    [
        T.StructField("season_label", T.StringType(), False),
        T.StructField("start_date", T.DateType(), False),
        T.StructField("end_date", T.DateType(), False),
    ]
)


def seasons(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SEASONS, _SEASON_SCHEMA)


def competitions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(COMPETITIONS, _COMPETITION_SCHEMA)


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A seed at rest, with declared column types. A file with a header only is an empty table."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def _packaged(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    text = resources.files("touchline").joinpath("seeds", name).read_text(encoding="utf-8")
    rows = csv.DictReader(text.splitlines())
    return spark.createDataFrame(
        [tuple(row[c] or None for c in schema.names) for row in rows], schema
    )


def team_aliases(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The alias table; the one that ships with the package unless a path is given."""
    if path:
        return read_seed(spark, path, TEAM_ALIASES)
    return _packaged(spark, "team_name_mappings.csv", TEAM_ALIASES)


def player_overrides(spark: SparkSession, path: str | None = None) -> DataFrame:
    if path:
        return read_seed(spark, path, PLAYER_OVERRIDES)
    return _packaged(spark, "player_match_overrides.csv", PLAYER_OVERRIDES)
