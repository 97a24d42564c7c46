"""Explicit schemas of raw tables, seeds and page corpora.

``required`` columns are the ones a record cannot do without; see ``sources.records``.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}


def record_schema(spec: str, required: str = "") -> T.StructType:
    needed = set(required.split())
    fields = []
    for item in spec.split(","):
        name, kind = item.split()
        fields.append(T.StructField(name, _TYPES[kind], name not in needed))
    return T.StructType(fields)


METADATA = record_schema("_ingested_at timestamp, _source_url string, _season string")

FBREF_STATS = record_schema(
    "player_id string, player_name string, team_id string, team_name string, league string,"
    "season string, nationality string, position string, age string, games int,"
    "games_starts int, minutes int, goals int, assists int, goals_pens int, pens_made int,"
    "pens_att int, cards_yellow int, cards_red int, xg double, npxg double, xg_assist double,"
    "goals_per90 double, assists_per90 double, goals_assists_per90 double,"
    "goals_pens_per90 double, goals_assists_pens_per90 double, xg_per90 double,"
    "xg_assist_per90 double, xg_xg_assist_per90 double, npxg_per90 double,"
    "npxg_xg_assist_per90 double, is_multi_team_row boolean, is_multi_team_total boolean",
    "player_id player_name team_id team_name league season is_multi_team_row is_multi_team_total",
)

UNDERSTAT_STATS = record_schema(
    "player_id string, player_name string, team_name string, league string, season string,"
    "position string, games int, minutes int, goals int, assists int, npg int, xg double,"
    "xg_assist double, npxg double, xg_chain double, xg_buildup double, shots int,"
    "key_passes int, yellow_cards int, red_cards int",
    "player_id player_name team_name league season",
)

TRANSFERMARKT_VALUATIONS = record_schema(
    "player_id string, player_name string, team_id string, team_name string, league string,"
    "season string, position string, date_of_birth string, nationality string, age int,"
    "market_value_eur bigint",
    "player_id player_name team_id team_name league season",
)

TEAM_ALIASES = record_schema(
    "source string, source_team_name string, canonical_team_name string, league string"
)

PLAYER_OVERRIDES = record_schema(
    "fbref_player_id string, understat_player_id string, transfermarkt_player_id string,"
    "canonical_player_id string, override_reason string"
)

PAGES = record_schema(
    "source string, league string, season string, page_no int, url string, body string"
)

RAW_TABLES = {
    "raw_fbref__player_season_stats": FBREF_STATS,
    "raw_understat__player_season_stats": UNDERSTAT_STATS,
    "raw_transfermarkt__player_valuations": TRANSFERMARKT_VALUATIONS,
}


def with_metadata(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + METADATA.fields)


def required_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if not f.nullable]


def as_nullable(schema: T.StructType) -> T.StructType:
    """Same columns without NOT NULL, for reading records that are yet to be checked."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
