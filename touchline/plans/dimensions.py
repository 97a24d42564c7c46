"""Season, competition, team and player dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions.keys import surrogate_key
from touchline.operators.latest import first_per_group
from touchline.sources.seeds import competitions, seasons


def dim_season(spark: SparkSession) -> DataFrame:
    return seasons(spark).select(
        surrogate_key("season_label").alias("season_key"), "season_label", "start_date", "end_date"
    )


def dim_competition(spark: SparkSession) -> DataFrame:
    return competitions(spark).select(
        surrogate_key("competition_name").alias("competition_key"),
        "competition_name", "country", "tier",
    )


def dim_team(stg_fbref: DataFrame, xref: DataFrame) -> DataFrame:
    """One row per FBref team; of several spellings the alphabetically first is shown."""
    spellings = stg_fbref.select(
        "fbref_team_id", "team_name_raw", "team_name", "league"
    ).distinct()
    shown = first_per_group(
        spellings,
        ["fbref_team_id"],
        [F.col("team_name_raw").asc_nulls_last(), F.col("league").asc_nulls_last()],
    )
    links = xref.select(
        "fbref_team_id", "canonical_team_id", "understat_team_name", "transfermarkt_team_id"
    )
    canonical = F.coalesce("canonical_team_id", "fbref_team_id")
    return shown.join(links, "fbref_team_id", "left").select(
        surrogate_key(canonical).alias("team_key"),
        canonical.alias("canonical_team_id"),
        F.col("team_name_raw").alias("full_name"),
        F.col("team_name").alias("short_name"),
        "league",
        "fbref_team_id",
        F.col("understat_team_name").alias("understat_team_id"),
        "transfermarkt_team_id",
    )


def dim_player(stg_fbref: DataFrame, xref: DataFrame) -> DataFrame:
    """One row per FBref player with the attributes and ids of the latest season.

    Both sides are reduced on the player id, so the join needs no exchange of its own.
    """
    attributes = first_per_group(
        stg_fbref.select(
            "fbref_player_id", "player_name_raw", "player_name", "nationality", "position",
            "age_years", "season", "minutes", "fbref_team_id",
        ),
        ["fbref_player_id"],
        [
            F.col("season").desc_nulls_last(),
            F.col("minutes").desc_nulls_last(),
            F.col("fbref_team_id").asc_nulls_last(),
            F.col("player_name_raw").asc_nulls_last(),
            F.col("position").asc_nulls_last(),
            F.col("age_years").asc_nulls_last(),
        ],
    )
    ids = first_per_group(
        xref.select(
            "fbref_player_id", "canonical_player_id", "understat_player_id",
            "transfermarkt_player_id", "season",
        ),
        ["fbref_player_id"],
        [F.col("season").desc_nulls_last(), F.col("canonical_player_id").asc_nulls_last()],
    ).drop("season")
    return attributes.join(ids, "fbref_player_id").select(
        surrogate_key("canonical_player_id").alias("player_key"),
        "canonical_player_id",
        F.col("player_name_raw").alias("full_name"),
        F.col("player_name").alias("short_name"),
        "nationality",
        F.col("position").alias("primary_position"),
        "age_years",
        "fbref_player_id",
        F.col("understat_player_id").alias("understat_id"),
        F.col("transfermarkt_player_id").alias("transfermarkt_id"),
    )
