"""Facts at player, team and season grain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.keys import packed, surrogate_key, unpacked

FBREF_MEASURES = [
    "games", "games_starts", "minutes", "goals", "assists", "goals_non_penalty",
    "penalties_scored", "penalties_attempted", "yellow_cards", "red_cards",
]
FBREF_EXPECTED = ["xg", "npxg", "xg_assist"]
FBREF_RATES = [
    "goals_per90", "assists_per90", "goals_assists_per90", "xg_per90", "xg_assist_per90",
]
_UNDERSTAT_MEASURES = [
    "understat_xg", "understat_xg_assist", "understat_npxg", "xg_chain", "xg_buildup",
    "understat_shots", "key_passes",
]


def _season_keys(dim_season: DataFrame) -> DataFrame:
    # A constant relation of three rows.
    return F.broadcast(dim_season.select("season_key", F.col("season_label").alias("season")))


def _competition_keys(dim_competition: DataFrame) -> DataFrame:
    # A constant relation of five rows.
    return F.broadcast(
        dim_competition.select("competition_key", F.col("competition_name").alias("league"))
    )


def _in_scope(rows: DataFrame, dim_season: DataFrame, dim_competition: DataFrame) -> DataFrame:
    """Rows of a known season and league. Their keys are added after the shuffles, or they would be moved with each row."""
    return rows.join(_season_keys(dim_season).select("season"), "season", "left_semi").join(
        _competition_keys(dim_competition).select("league"), "league", "left_semi")


def _with_scope_keys(rows: DataFrame, dim_season: DataFrame, dim_competition: DataFrame) -> DataFrame:
    return rows.join(_season_keys(dim_season), "season").join(_competition_keys(dim_competition), "league")


def fct_player_season_stats(
    stg_fbref: DataFrame,
    stg_understat: DataFrame,
    player_xref: DataFrame,
    team_xref: DataFrame,
    dim_player: DataFrame,
    dim_team: DataFrame,
    dim_season: DataFrame,
    dim_competition: DataFrame,
    clean: bool = False,
) -> DataFrame:
    """FBref statistics per player, team and season, enriched from Understat by player and season.

    The two constant dimensions are broadcast: they drop rows out of scope before anything is shuffled and give their keys
    after it. Players and teams grow with the data, so their joins carry no hint.

    By default players are looked up by their source id and a player of several clubs gets every
    club's enrichment in each row, as in the original semantics. ``clean`` looks players up through
    the cross-reference and enriches a row from the same club only.
    """
    own_id = "fbref_player_id" if clean else "canonical_player_id"
    players = dim_player.select("player_key", F.col(own_id).alias("fbref_player_id"))
    teams = dim_team.select("team_key", "fbref_team_id")
    matched = player_xref.filter(F.col("understat_player_id").isNotNull()).select(
        "understat_player_id", "season", "fbref_player_id"
    )
    known_teams = team_xref.select(
        F.col("understat_team_name").alias("team_name"), *(["league", "fbref_team_id"] if clean else [])
    ).dropna()
    rows_of = ["fbref_player_id", "season", *(["fbref_team_id"] if clean else [])]
    enrichment = (
        stg_understat.select(
            "understat_player_id", "season", "team_name", *(["league"] if clean else []),
            F.col("xg").alias("understat_xg"),
            F.col("xg_assist").alias("understat_xg_assist"),
            F.col("npxg").alias("understat_npxg"),
            "xg_chain", "xg_buildup", F.col("shots").alias("understat_shots"), "key_passes",
        )
        .join(_season_keys(dim_season).select("season"), "season", "left_semi")
        .join(known_teams, ["team_name", "league"] if clean else "team_name")
        .join(matched, ["understat_player_id", "season"])
        .select(*rows_of, *_UNDERSTAT_MEASURES, F.lit(True).alias("_enriched"))
    )
    rows = _in_scope(
        stg_fbref.select(
            "fbref_player_id", "fbref_team_id", "league", "season",
            *FBREF_MEASURES, *FBREF_EXPECTED, *FBREF_RATES,
        ),
        dim_season, dim_competition,
    ).join(teams, "fbref_team_id")
    rows = rows.withColumn("team_key", packed("team_key")).join(players, "fbref_player_id")
    return (
        _with_scope_keys(rows, dim_season, dim_competition)
        .withColumn("team_key", unpacked("team_key"))
        # The enrichment repeats rows: the key is worked out before.
        .withColumn("player_season_stats_key", surrogate_key("player_key", "team_key", "season_key"))
        .join(enrichment, rows_of, "left")
        .select(
            "player_season_stats_key",
            "player_key", "team_key", "competition_key", "season_key",
            *FBREF_MEASURES,
            *[F.col(c).alias(f"fbref_{c}") for c in FBREF_EXPECTED],
            *FBREF_RATES,
            *_UNDERSTAT_MEASURES,
            F.when(F.col("_enriched"), F.array(F.lit("fbref"), F.lit("understat")))
            .otherwise(F.array(F.lit("fbref")))
            .alias("_sources"),
        )
    )


def fct_player_season_valuations(
    stg_transfermarkt: DataFrame,
    player_xref: DataFrame,
    team_xref: DataFrame,
    dim_player: DataFrame,
    dim_team: DataFrame,
    dim_season: DataFrame,
    dim_competition: DataFrame,
) -> DataFrame:
    """Market value per player, team and season.

    A valuation without a team in the cross-reference cannot reach the team dimension, so the
    optional team join of the resolution step is written as an inner join.
    """
    matched = player_xref.filter(F.col("transfermarkt_player_id").isNotNull()).select(
        "transfermarkt_player_id", "season", "canonical_player_id"
    )
    clubs = team_xref.select(
        F.col("transfermarkt_team_name").alias("team_name"), "league", "canonical_team_id"
    ).dropna(subset=["team_name"])
    # The keys are resolved on clubs and on matched players, so the valuations move once for each of both.
    clubs = clubs.join(dim_team.select("team_key", "canonical_team_id"), "canonical_team_id")
    people = matched.join(dim_player.select("player_key", "canonical_player_id"), "canonical_player_id")
    clubs, people = clubs.drop("canonical_team_id"), people.drop("canonical_player_id")
    rows = (
        _in_scope(
            stg_transfermarkt.select(
                "transfermarkt_player_id", "season", "league", "team_name",
                "market_value_eur", "date_of_birth", "nationality",
            ),
            dim_season, dim_competition,
        )
        .join(clubs, ["team_name", "league"])
        .withColumn("team_key", packed("team_key"))
        .join(people, ["transfermarkt_player_id", "season"])
    )
    return (
        _with_scope_keys(rows, dim_season, dim_competition)
        .withColumn("team_key", unpacked("team_key"))
        .select(
            surrogate_key("player_key", "team_key", "season_key").alias("valuation_key"),
            "player_key", "team_key", "season_key", "competition_key",
            "market_value_eur", "date_of_birth", "nationality",
        )
    )
