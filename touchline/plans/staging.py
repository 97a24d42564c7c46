"""Raw tables to typed, normalised and filtered staging relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.keys import surrogate_key
from touchline.functions.names import normalize_player_name, normalize_team_name
from touchline.functions.positions import position_group
from touchline.functions.text import age_years, iso_date, written_date
from touchline.operators.latest import first_per_group


# The surrogate key of each staging relation and the columns that it is made of.
KEYS = {
    "stg_fbref__player_season_stats": ("player_season_team_id", ["fbref_player_id", "fbref_team_id", "season"]),
    "stg_understat__player_season_stats": ("player_season_team_id", ["understat_player_id", "team_name_raw", "season"]),
    "stg_transfermarkt__player_valuations": (
        "player_valuation_id", ["transfermarkt_player_id", "transfermarkt_team_id", "season"]),
}


def _ints(**renames: str) -> list[Column]:
    return [F.col(src).try_cast("int").alias(dst) for dst, src in renames.items()]


def _doubles(*names: str) -> list[Column]:
    return [F.col(name).try_cast("double").alias(name) for name in names]


def _names() -> list[Column]:
    return [
        F.col("player_name").alias("player_name_raw"),
        normalize_player_name(F.col("player_name")).alias("player_name"),
        F.col("team_name").alias("team_name_raw"),
        normalize_team_name(F.col("team_name")).alias("team_name"),
    ]


def _played(minutes: Column) -> Column:
    """Rows of players who never played go, rows with unknown minutes stay."""
    return minutes.isNull() | (minutes > 0)


def _fbref_rows(raw: DataFrame) -> DataFrame:
    # Filters sit on raw columns, below the projection, so that they reach the Parquet scan.
    return raw.filter(~F.col("is_multi_team_total").cast("boolean")).filter(
        _played(F.col("minutes").try_cast("int"))
    )


def stage_fbref(raw: DataFrame) -> DataFrame:
    return _fbref_rows(raw).select(
        surrogate_key("player_id", "team_id", "_season").alias("player_season_team_id"),
        F.col("player_id").alias("fbref_player_id"),
        F.col("team_id").alias("fbref_team_id"),
        "league",
        F.col("_season").alias("season"),
        *_names(),
        "nationality",
        "position",
        age_years(F.col("age")).alias("age_years"),
        F.col("age").alias("age_raw"),
        *_ints(
            games="games",
            games_starts="games_starts",
            minutes="minutes",
            goals="goals",
            assists="assists",
            goals_non_penalty="goals_pens",
            penalties_scored="pens_made",
            penalties_attempted="pens_att",
            yellow_cards="cards_yellow",
            red_cards="cards_red",
        ),
        *_doubles(
            "xg", "npxg", "xg_assist", "goals_per90", "assists_per90", "goals_assists_per90",
            "xg_per90", "xg_assist_per90",
        ),
        F.col("is_multi_team_total").cast("boolean").alias("is_multi_team_total"),
        F.col("is_multi_team_row").cast("boolean").alias("is_multi_team_row"),
        "_ingested_at",
        "_source_url",
    )


def _understat_rows(raw: DataFrame) -> DataFrame:
    return raw.filter(_played(F.col("minutes").try_cast("int")))


def stage_understat(raw: DataFrame) -> DataFrame:
    return _understat_rows(raw).select(
        surrogate_key("player_id", "team_name", "_season").alias("player_season_team_id"),
        F.col("player_id").alias("understat_player_id"),
        F.col("_season").alias("season"),
        *_names(),
        "league",
        F.col("position").alias("position_raw"),
        position_group(F.col("position")).alias("position_group"),
        *_ints(games="games", minutes="minutes", goals="goals", assists="assists", npg="npg"),
        *_doubles("xg", "xg_assist", "npxg", "xg_chain", "xg_buildup"),
        *_ints(
            shots="shots",
            key_passes="key_passes",
            yellow_cards="yellow_cards",
            red_cards="red_cards",
        ),
        "_ingested_at",
        "_source_url",
    )


def _last_valuations(raw: DataFrame) -> DataFrame:
    """Rows are dealt by player alone: the rows of a player lie together, in the shuffle and in what is written, so that
    names and sources compress and a later pick per player and season has them in one task. A player has few rows, and
    no valuation lacks its player (``schemas``)."""
    return first_per_group(
        raw.repartition("player_id"),
        ["player_id", "team_id", "_season"],
        [
            F.col("_ingested_at").desc_nulls_last(),
            F.col("league").asc_nulls_last(),
            F.col("_source_url").asc_nulls_last(),
            F.col("player_name").asc_nulls_last(),
        ],
    )


def stage_transfermarkt(raw: DataFrame, strict_parity: bool = False) -> DataFrame:
    """Last ingested row per player, team and season.

    Birth dates come as 'Jul 21, 2000'. ``strict_parity`` accepts ISO dates only, which leaves
    the column NULL for that form.
    """
    born = F.col("date_of_birth")
    birth_date = iso_date(born) if strict_parity else F.coalesce(written_date(born), iso_date(born))
    return _last_valuations(raw).select(
        surrogate_key("player_id", "team_id", "_season").alias("player_valuation_id"),
        F.col("player_id").alias("transfermarkt_player_id"),
        F.col("team_id").alias("transfermarkt_team_id"),
        F.col("_season").alias("season"),
        *_names(),
        "league",
        "position",
        "nationality",
        birth_date.alias("date_of_birth"),
        F.col("age").try_cast("int").alias("age_years"),
        F.col("market_value_eur").try_cast("bigint").alias("market_value_eur"),
        "_ingested_at",
        "_source_url",
    )


def _clubs(rows: DataFrame, **renames: str) -> DataFrame:
    """Distinct clubs of rows; a name is normalised once per club and not once per row."""
    clubs = rows.select(*[F.col(src).alias(dst) for dst, src in renames.items()], "team_name", "league").distinct()
    return clubs.withColumn("team_name", normalize_team_name(F.col("team_name")))


def fbref_clubs(raw: DataFrame) -> DataFrame:
    """The clubs that ``stage_fbref`` names, without staging a row."""
    return _clubs(_fbref_rows(raw), fbref_team_id="team_id")


def understat_clubs(raw: DataFrame) -> DataFrame:
    """The clubs that ``stage_understat`` names, without staging a row."""
    return _clubs(_understat_rows(raw))


def transfermarkt_clubs(raw: DataFrame) -> DataFrame:
    """The clubs that ``stage_transfermarkt`` names, without staging a row."""
    return _clubs(_last_valuations(raw), transfermarkt_team_id="team_id")
