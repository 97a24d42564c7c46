"""Football-shaped raw tables derived from the benchmark tables.

A part is a player, a supplier is a club, the ship date gives the season and the region of the
supplier the league; lines of one part, supplier and season make one player-season row. The texts
below are plain SQL that both engines run, so that both start from the same raw rows; everything
after that is written twice, as DataFrame code in the library and as SQL in ``oracle``.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.plans.warehouse import Warehouse
from touchline.schemas import (
    FBREF_STATS,
    PLAYER_OVERRIDES,
    TEAM_ALIASES,
    TRANSFERMARKT_VALUATIONS,
    UNDERSTAT_STATS,
    with_metadata,
)
from touchline.session import CODEC, FILE_ROWS, free_shuffles, shared_folder, small_scans, written

CLUBS = """
SELECT s_suppkey AS s,
  CASE n_regionkey WHEN 0 THEN 'Premier League' WHEN 1 THEN 'La Liga' WHEN 2 THEN 'Bundesliga'
    WHEN 3 THEN 'Serie A' ELSE 'Ligue 1' END AS league,
  CASE s_suppkey % 4 WHEN 0 THEN 'Club Número ' WHEN 1 THEN 'Ünited ' WHEN 2 THEN 'City '
    ELSE 'Atlético ' END || CAST(s_suppkey AS STRING)
    || CASE s_suppkey % 4 WHEN 1 THEN ' FC' ELSE '' END AS fbref_team,
  CASE s_suppkey % 4 WHEN 0 THEN 'club numero ' WHEN 1 THEN 'United ' WHEN 2 THEN 'City '
    ELSE 'Athletic ' END || CAST(s_suppkey AS STRING) AS understat_team,
  CASE s_suppkey % 4 WHEN 0 THEN 'CLUB NUMERO ' WHEN 1 THEN 'FC United ' WHEN 2 THEN 'AC City '
    ELSE 'Atletico ' END || CAST(s_suppkey AS STRING) AS transfermarkt_team
FROM supplier JOIN nation ON s_nationkey = n_nationkey
"""

PLAYERS = """
SELECT p_partkey AS p, p_name, p_type AS kind, p_brand AS brand, p_size AS size,
  p_type || CAST(p_size AS STRING) AS family,
  CASE WHEN p_partkey % 3 = 0 THEN replace(replace(p_name, 'e', 'é'), 'o', 'ö') ELSE p_name END
    AS spelled,
  p_retailprice AS price
FROM part
"""

LINES = """
SELECT l_partkey AS p, l_suppkey AS s,
  CASE year(l_shipdate) % 4 WHEN 0 THEN '2023-2024' WHEN 1 THEN '2024-2025'
    WHEN 2 THEN '2025-2026' ELSE '2022-2023' END AS season,
  CAST(sum(l_quantity) AS BIGINT) AS qty, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS ln
FROM lineitem GROUP BY 1, 2, 3
"""

_STAMP = """TIMESTAMP '2025-06-01 00:00:00' AS _ingested_at,
  'https://corpus.example/' || season AS _source_url, season AS _season"""

_FBREF_NUMBERS = """
  CAST(n AS INT) AS games, CAST(n AS INT) AS games_starts,
  CAST(CASE WHEN (p + s) % 17 = 0 THEN 0 WHEN (p + s) % 19 = 0 THEN NULL ELSE qty * 3 END AS INT)
    AS minutes,
  CAST(ln % 9 AS INT) AS goals, CAST(ln % 5 AS INT) AS assists, CAST(ln % 7 AS INT) AS goals_pens,
  CAST(ln % 2 AS INT) AS pens_made, CAST(ln % 3 AS INT) AS pens_att,
  CAST(n % 4 AS INT) AS cards_yellow, CAST(n % 2 AS INT) AS cards_red,
  CAST(ln AS DOUBLE) / 8 AS xg, CAST(ln AS DOUBLE) / 16 AS npxg, CAST(n AS DOUBLE) / 4 AS xg_assist,
  CAST(ln AS DOUBLE) / 32 AS goals_per90, CAST(n AS DOUBLE) / 32 AS assists_per90,
  CAST(ln + n AS DOUBLE) / 32 AS goals_assists_per90, CAST(ln AS DOUBLE) / 64 AS goals_pens_per90,
  CAST(qty AS DOUBLE) / 64 AS goals_assists_pens_per90, CAST(ln AS DOUBLE) / 128 AS xg_per90,
  CAST(n AS DOUBLE) / 128 AS xg_assist_per90, CAST(qty AS DOUBLE) / 128 AS xg_xg_assist_per90,
  CAST(ln AS DOUBLE) / 256 AS npxg_per90, CAST(qty AS DOUBLE) / 256 AS npxg_xg_assist_per90"""

_FBREF_PERSON = """'f' || CAST(p AS STRING) AS player_id,
  spelled || ' ' || family AS player_name"""

_FBREF_BIO = """CASE p % 3 WHEN 0 THEN 'eg EGY' WHEN 1 THEN 'no NOR' ELSE NULL END AS nationality,
  CASE p % 7 WHEN 0 THEN 'FW' WHEN 1 THEN 'FW,MF' WHEN 2 THEN 'MF' WHEN 3 THEN 'DF'
    WHEN 4 THEN 'GK' WHEN 5 THEN 'DF,MF' ELSE NULL END AS position,
  CASE WHEN p % 23 = 0 THEN NULL WHEN p % 29 = 0 THEN '27'
    ELSE CAST(18 + p % 20 AS STRING) || '-' || lpad(CAST(p * 7 % 365 AS STRING), 3, '0') END
    AS age"""

# One row per club, and a total row where a player had several clubs in a season.
RAW_FBREF = f"""
SELECT {_FBREF_PERSON}, CAST(s AS STRING) AS team_id, fbref_team AS team_name, league, season,
  {_FBREF_BIO}, {_FBREF_NUMBERS},
  n > 1 AS is_multi_team_row, FALSE AS is_multi_team_total, {_STAMP}
FROM {{lines}} JOIN {{clubs}} USING (s) JOIN {{players}} USING (p)
UNION ALL
SELECT {_FBREF_PERSON}, '' AS team_id, CAST(n AS STRING) || ' Clubs' AS team_name, league, season,
  {_FBREF_BIO}, {_FBREF_NUMBERS},
  FALSE AS is_multi_team_row, TRUE AS is_multi_team_total, {_STAMP}
FROM (
  SELECT p, season, min(league) AS league, min(s) AS s, CAST(sum(qty) AS BIGINT) AS qty,
    count(*) AS n, CAST(sum(ln) AS BIGINT) AS ln
  FROM {{lines}} JOIN {{clubs}} USING (s) GROUP BY 1, 2 HAVING count(*) > 1
) total JOIN {{players}} USING (p)
"""

# Most names agree, some are swapped, cut or stretched; one brand is missing, one is there twice.
_UNDERSTAT_NAME = """CASE p % 6
    WHEN 3 THEN split_part(p_name, ' ', 2) || ' ' || split_part(p_name, ' ', 1)
    WHEN 4 THEN substr(p_name, 2) WHEN 5 THEN replace(p_name, 'a', 'aa') ELSE p_name END
    || ' ' || family AS player_name"""

_UNDERSTAT_BODY = f"""{_UNDERSTAT_NAME}, understat_team AS team_name, league, season,
  CASE p % 7 WHEN 0 THEN 'F S' WHEN 1 THEN 'M C' WHEN 2 THEN 'M C S' WHEN 3 THEN 'D C'
    WHEN 4 THEN 'GK' WHEN 5 THEN 'Sub' ELSE 'F' END AS position,
  CAST(n AS INT) AS games,
  CAST(CASE WHEN (p + s) % 17 = 0 THEN 0 ELSE qty * 3 END AS INT) AS minutes,
  CAST(ln % 9 AS INT) AS goals, CAST(ln % 5 AS INT) AS assists, CAST(ln % 7 AS INT) AS npg,
  CAST(ln AS DOUBLE) / 8 AS xg, CAST(n AS DOUBLE) / 4 AS xg_assist, CAST(ln AS DOUBLE) / 16 AS npxg,
  CAST(qty AS DOUBLE) / 8 AS xg_chain, CAST(qty AS DOUBLE) / 16 AS xg_buildup,
  CAST(CASE WHEN p % 31 = 0 THEN 0 ELSE n * 3 END AS INT) AS shots,
  CAST(n % 6 AS INT) AS key_passes, CAST(n % 4 AS INT) AS yellow_cards,
  CAST(n % 2 AS INT) AS red_cards, {_STAMP}"""

RAW_UNDERSTAT = f"""
SELECT 'u' || CAST(p AS STRING) AS player_id, {_UNDERSTAT_BODY}
FROM {{lines}} JOIN {{clubs}} USING (s) JOIN {{players}} USING (p) WHERE brand <> 'Brand#3'
UNION ALL
SELECT 'a' || CAST(p AS STRING) AS player_id, {_UNDERSTAT_BODY}
FROM {{lines}} JOIN {{clubs}} USING (s) JOIN {{players}} USING (p) WHERE brand = 'Brand#7'
"""

_TRANSFERMARKT_BODY = """'t' || CAST(p AS STRING) AS player_id,
  CASE p % 5 WHEN 3 THEN 'de la ' || p_name WHEN 4 THEN substr(p_name, 1, length(p_name) - 1)
    ELSE p_name END || ' ' || family AS player_name,
  CAST(s + 500000 AS STRING) AS team_id, transfermarkt_team AS team_name, league, season,
  CASE p % 7 WHEN 0 THEN 'Centre-Forward' WHEN 1 THEN 'Left Winger' WHEN 2 THEN 'Central Midfield'
    WHEN 3 THEN 'Centre-Back' WHEN 4 THEN 'Goalkeeper' WHEN 5 THEN 'Right Midfield' ELSE NULL END
    AS position,
  CASE WHEN p % 5 = 0 THEN CAST(1985 + p % 20 AS STRING) || '-03-0' || CAST(1 + p % 9 AS STRING)
    WHEN p % 5 = 1 THEN NULL
    ELSE CASE p % 4 WHEN 0 THEN 'Jan ' WHEN 1 THEN 'May ' WHEN 2 THEN 'Sep ' ELSE 'Dec ' END
      || CAST(1 + p % 28 AS STRING) || ', ' || CAST(1985 + p % 20 AS STRING) END AS date_of_birth,
  CASE WHEN p % 11 = 0 THEN NULL ELSE 'Norway' END AS nationality,
  CAST(18 + p % 20 AS INT) AS age"""

# One kind of player is missing; another was ingested twice, the later batch with another value.
RAW_TRANSFERMARKT = f"""
SELECT {_TRANSFERMARKT_BODY},
  CASE WHEN p % 37 = 0 THEN NULL WHEN p % 41 = 0 THEN 3000000000
    ELSE qty * 1000000 + CAST(floor(price) AS BIGINT) END AS market_value_eur, {_STAMP}
FROM {{lines}} JOIN {{clubs}} USING (s) JOIN {{players}} USING (p) WHERE kind <> 'PROMO'
UNION ALL
SELECT {_TRANSFERMARKT_BODY}, qty * 500000 AS market_value_eur,
  TIMESTAMP '2025-01-01 00:00:00' AS _ingested_at,
  'https://corpus.example/' || season AS _source_url, season AS _season
FROM {{lines}} JOIN {{clubs}} USING (s) JOIN {{players}} USING (p) WHERE kind = 'SMALL'
"""

ALIASES = """
SELECT 'fbref' AS source, 'united ' || CAST(s AS STRING) || ' fc' AS source_team_name,
  'united ' || CAST(s AS STRING) AS canonical_team_name, league FROM {clubs} WHERE fbref_team LIKE 'Ünited %'
UNION ALL
SELECT 'transfermarkt' AS source, 'fc united ' || CAST(s AS STRING) AS source_team_name,
  'united ' || CAST(s AS STRING) AS canonical_team_name, league FROM {clubs} WHERE fbref_team LIKE 'Ünited %'
UNION ALL
SELECT 'understat' AS source, 'athletic ' || CAST(s AS STRING) AS source_team_name,
  'atletico ' || CAST(s AS STRING) AS canonical_team_name, league FROM {clubs} WHERE understat_team LIKE 'Athletic %' AND league <> 'Ligue 1'
"""

OVERRIDES = """
SELECT 'f' || CAST(p AS STRING) AS fbref_player_id,
  CASE WHEN p % 2 = 0 THEN 'u' || CAST(p + 1 AS STRING) ELSE NULL END AS understat_player_id,
  CASE WHEN p % 5 = 0 THEN 't' || CAST(p + 1 AS STRING) ELSE NULL END AS transfermarkt_player_id,
  CASE WHEN p % 3 = 0 THEN 'c' ELSE 'f' END || CAST(p AS STRING) AS canonical_player_id,
  'checked by hand' AS override_reason
FROM {players} WHERE size = 4
"""

def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _query(spark: SparkSession, text: str, schema, **inputs: DataFrame) -> DataFrame:
    df = spark.sql(text, **inputs)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


# How the raw tables bring lines, clubs and players together. Names of clubs are joined last: they are long.
_JOINED = "FROM {lines} JOIN {clubs} USING (s) JOIN {players} USING (p)"
_LINE_COLUMNS = ["l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_linenumber"]
_PLAYED = "SELECT * FROM {lines} JOIN {players} USING (p) JOIN {clubs} USING (s)"


def inputs(
    spark: SparkSession, sf_dir: str, join_once: bool = False
) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    """(raw tables, aliases, overrides) over the benchmark tables; raw tables are lazy.

    With ``join_once`` the join that all raw tables begin with is written: where players are too many for a broadcast,
    each of them would otherwise shuffle and sort all lines again. Lines are dealt by player then, which serves their groups
    and the join, and are not written beside it; only the totals, which staging leaves out, work them out again.
    """

    def base(text: str, *tables: str, **frames: DataFrame) -> DataFrame:
        frames = {t: read(spark, sf_dir, t) for t in tables} | frames
        for t in tables:
            text = text.replace(f"FROM {t} ", f"FROM {{{t}}} ").replace(f"JOIN {t} ", f"JOIN {{{t}}} ")
            text = text.replace(f"FROM {t}\n", f"FROM {{{t}}}\n")
        return spark.sql(text, **frames)

    small_scans(spark)
    free_shuffles(spark)
    # All three raw tables read the lines and the clubs: written once, with sizes that the planner
    # knows, instead of being aggregated and joined again under each of them.
    folder = shared_folder(spark)
    shared = {"clubs": base(CLUBS, "supplier", "nation")}
    parts = {}
    if join_once:
        lineitem = read(spark, sf_dir, "lineitem").select(*_LINE_COLUMNS).repartition("l_partkey")
        parts["lines"] = base(LINES, "lineitem", lineitem=lineitem)
    else:
        shared["lines"] = base(LINES, "lineitem")
    with ThreadPoolExecutor(len(shared)) as jobs:
        parts |= zip(shared, jobs.map(lambda n: written(shared[n], folder, n, FILE_ROWS, CODEC), shared))
    parts["players"] = base(PLAYERS, "part")
    raw_texts = [RAW_FBREF, RAW_UNDERSTAT, RAW_TRANSFERMARKT]
    if join_once:
        parts["played"] = written(spark.sql(_PLAYED, **parts), folder, "played", FILE_ROWS, CODEC)
        raw_texts = [text.replace(_JOINED, "FROM {played}") for text in raw_texts]
    raw_fbref, raw_understat, raw_transfermarkt = raw_texts
    raw = {
        "raw_fbref__player_season_stats": _query(
            spark, raw_fbref, with_metadata(FBREF_STATS), **parts
        ),
        "raw_understat__player_season_stats": _query(
            spark, raw_understat, with_metadata(UNDERSTAT_STATS), **parts
        ),
        "raw_transfermarkt__player_valuations": _query(
            spark, raw_transfermarkt, with_metadata(TRANSFERMARKT_VALUATIONS), **parts
        ),
    }
    aliases = _query(spark, ALIASES, TEAM_ALIASES, clubs=parts["clubs"])
    overrides = _query(spark, OVERRIDES, PLAYER_OVERRIDES, players=parts["players"])
    return raw, aliases, overrides


def built(spark: SparkSession, sf_dir: str, **modes) -> Warehouse:
    """The whole warehouse over the derived raw tables."""
    return Warehouse(*inputs(spark, sf_dir, join_once=True), **modes)
