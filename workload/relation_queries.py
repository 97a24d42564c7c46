"""The relations of the warehouse over the derived raw tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.operators.quality import run_data_tests
from touchline.plans import checks, dimensions, players, staging, teams
from touchline.plans.checks import DATA_TESTS
from touchline.session import CODEC, shared_folder, written
from workload import oracle
from workload.league import built, inputs, read
from workload.oracle import over_chain
from workload.registry import query

_HIDDEN = ["_ingested_at", "_source_url"]


def _shown(df: DataFrame) -> DataFrame:
    """Dates and arrays as text and scores rounded, so that both engines hash the same values."""
    out = []
    for name, kind in df.dtypes:
        if name in _HIDDEN:
            continue
        c = F.col(name)
        if kind == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        elif kind == "array<string>":
            c = F.array_join(c, ",")
        elif name in ("confidence", "transfermarkt_confidence", "name_score", "composite_score"):
            c = F.round(c, 6)
        out.append(c.alias(name))
    return df.select(*out)


@query(over_chain("SELECT * FROM stg_fbref__player_season_stats"))
def stage_fbref(spark, sf_dir):
    raw, _, _ = inputs(spark, sf_dir)
    return _shown(staging.stage_fbref(raw["raw_fbref__player_season_stats"]))


@query(over_chain("SELECT * FROM stg_understat__player_season_stats"))
def stage_understat(spark, sf_dir):
    raw, _, _ = inputs(spark, sf_dir)
    return _shown(staging.stage_understat(raw["raw_understat__player_season_stats"]))


@query(
    over_chain(
        """SELECT * REPLACE (strftime(date_of_birth, '%Y-%m-%d') AS date_of_birth)
FROM stg_transfermarkt__player_valuations"""
    )
)
def stage_transfermarkt(spark, sf_dir):
    raw, _, _ = inputs(spark, sf_dir)
    return _shown(staging.stage_transfermarkt(raw["raw_transfermarkt__player_valuations"]))


@query(
    over_chain(
        """SELECT player_id AS transfermarkt_player_id, _season AS season,
  strftime(try_cast(date_of_birth AS DATE), '%Y-%m-%d') AS date_of_birth
FROM raw_transfermarkt__player_valuations
QUALIFY row_number() OVER (PARTITION BY player_id, team_id, _season ORDER BY _ingested_at DESC) = 1"""
    )
)
def stage_transfermarkt_strict(spark, sf_dir):
    raw, _, _ = inputs(spark, sf_dir)
    staged = staging.stage_transfermarkt(raw["raw_transfermarkt__player_valuations"], True)
    return _shown(staged.select("transfermarkt_player_id", "season", "date_of_birth"))


@query(over_chain("SELECT * FROM int_team_xref"))
def team_xref(spark, sf_dir):
    return built(spark, sf_dir, reads=[])["int_team_xref"]


@query(
    over_chain(
        """SELECT DISTINCT hub_name, other_name, league, season, round(name_score, 6) AS name_score,
  position_score FROM understat_pairs WHERE team_score = 1"""
    )
)
def blocked_candidates(spark, sf_dir):
    w = built(spark, sf_dir, reads=[])
    fbref, understat, _ = w.staged(only=["stg_fbref__player_season_stats", "stg_understat__player_season_stats"])
    pairs = players.candidates(
        players.main_fbref_rows(fbref),
        players.main_understat_rows(understat),
        w["int_team_xref"],
        players.UNDERSTAT,
    )
    return pairs.select(
        "hub_name", "other_name", "league", "season",
        F.round("name_score", 6).alias("name_score"), "position_score",
    ).distinct()


@query(
    over_chain(
        """SELECT * REPLACE (round(confidence, 6) AS confidence, round(name_score, 6) AS name_score,
  round(transfermarkt_confidence, 6) AS transfermarkt_confidence) FROM int_player_xref"""
    )
)
def player_xref(spark, sf_dir):
    return _shown(built(spark, sf_dir, reads=[])["int_player_xref"])


@query(
    over_chain(
        """SELECT * REPLACE (round(confidence, 6) AS confidence, round(name_score, 6) AS name_score,
  round(transfermarkt_confidence, 6) AS transfermarkt_confidence) FROM single_player_xref"""
    )
)
def player_xref_one_to_one(spark, sf_dir):
    return _shown(built(spark, sf_dir, one_to_one=True, reads=[])["int_player_xref"])


@query(
    over_chain(
        """SELECT * REPLACE (round(confidence, 6) AS confidence, round(name_score, 6) AS name_score,
  round(transfermarkt_confidence, 6) AS transfermarkt_confidence) FROM assigned_player_xref"""
    )
)
def player_xref_assigned(spark, sf_dir):
    return _shown(built(spark, sf_dir, assign=True, reads=[])["int_player_xref"])


_LADDER_NAMES = """SELECT *, lower(CASE k % 5 WHEN 0 THEN 'FC ' WHEN 1 THEN 'AC.' ELSE '' END || club || CASE k % 3 WHEN 0 THEN ' CF' ELSE '' END) AS hub_name,
  CASE WHEN k % 10 = 9 THEN 'alias of ' || club ELSE lower(CASE k % 4 WHEN 0 THEN 'SS ' ELSE '' END || club || CASE k % 7 WHEN 0 THEN '  FC' ELSE '' END) END AS other_name
FROM (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 11 = 0 THEN 'Club ' || s_suppkey // 22 ELSE 'Club Nr ' || s_suppkey END AS club,
  (s_nationkey % 5)::VARCHAR AS league FROM supplier)"""


@query(
    f"""WITH named AS ({_LADDER_NAMES}),
hub AS (SELECT 't' || k AS fbref_team_id, hub_name, lower(club) AS key, league FROM named),
other AS (SELECT DISTINCT other_name, CASE WHEN k % 10 = 9 THEN hub_name ELSE other_name END AS canonical,
  lower(club) AS key, league FROM named),
hubs AS (SELECT DISTINCT hub_name AS name, key, league FROM hub), others AS (SELECT DISTINCT canonical AS name, key, league FROM other),
found AS (
  SELECT o.name, h.name AS hub_name, o.league FROM hubs h JOIN others o USING (key, league)
  WHERE (SELECT count(*) FROM hubs x WHERE x.key = h.key AND x.league = h.league) = 1
    AND (SELECT count(*) FROM others x WHERE x.key = o.key AND x.league = o.league) = 1
    AND NOT EXISTS (SELECT 1 FROM others x WHERE x.name = h.name AND x.league = h.league)
    AND NOT EXISTS (SELECT 1 FROM hubs x WHERE x.name = o.name AND x.league = o.league)
), mapped AS (
  SELECT other_name, coalesce(f.hub_name, canonical) AS canonical, o.league
  FROM other o LEFT JOIN found f ON f.name = o.canonical AND f.league = o.league
)
SELECT fbref_team_id, h.hub_name AS fbref_team_name, m.other_name AS understat_team_name, h.league
FROM hub h LEFT JOIN mapped m ON m.canonical = h.hub_name AND m.league = h.league"""
)
def team_xref_ladder(spark, sf_dir):
    """Clubs by alias, by exact name and by affix-free name; some of these name two clubs and are refused."""
    k = F.col("k")
    named = read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("k"), (F.col("s_nationkey") % 5).cast("string").alias("league"),
        F.when(F.col("s_suppkey") % 11 == 0, F.concat(F.lit("Club "), F.floor(F.col("s_suppkey") / 22)))
        .otherwise(F.concat(F.lit("Club Nr "), "s_suppkey")).alias("club"),
    )
    def affixed(first, last):
        return F.lower(F.concat(first.otherwise(""), "club", last.otherwise("")))
    hub_name = affixed(F.when(k % 5 == 0, "FC ").when(k % 5 == 1, "AC."), F.when(k % 3 == 0, " CF"))
    other = affixed(F.when(k % 4 == 0, "SS "), F.when(k % 7 == 0, "  FC"))
    named = named.withColumns({
        "hub_name": hub_name, "other": F.when(k % 10 == 9, F.concat(F.lit("alias of "), "club")).otherwise(other)})
    aliases = named.filter(k % 10 == 9).select(
        F.lit("understat").alias("source"), F.col("other").alias("source_team_name"),
        F.col("hub_name").alias("canonical_team_name"), "league").distinct()
    xref = teams.team_xref(
        named.select(F.concat(F.lit("t"), "k").alias("fbref_team_id"), F.col("hub_name").alias("team_name"), "league"),
        named.select(F.col("other").alias("team_name"), "league"),
        named.select(F.lit("none").alias("transfermarkt_team_id"), F.lit("none").alias("team_name"), "league").filter("k < 0"),
        aliases, ladder=True)
    return xref.select("fbref_team_id", "fbref_team_name", "understat_team_name", "league")


@query(over_chain("SELECT * FROM dim_team"))
def dim_team(spark, sf_dir):
    return built(spark, sf_dir, reads=["dimensions"])["dim_team"]


@query(over_chain("SELECT * FROM dim_player"))
def dim_player(spark, sf_dir):
    return built(spark, sf_dir, reads=["dimensions"])["dim_player"]


@query(
    over_chain(
        """SELECT season_key, season_label, strftime(start_date, '%Y-%m-%d') AS start_date,
  strftime(end_date, '%Y-%m-%d') AS end_date, competition_key, competition_name, country, tier,
  count(*) AS n_rows
FROM stg_fbref__player_season_stats JOIN dim_season ON season = season_label
JOIN dim_competition ON league = competition_name GROUP BY ALL"""
    )
)
def constant_dimensions(spark, sf_dir):
    raw, _, _ = inputs(spark, sf_dir)
    staged = staging.stage_fbref(raw["raw_fbref__player_season_stats"])
    counted = staged.groupBy("season", "league").agg(F.count(F.lit(1)).alias("n_rows"))
    seasons = dimensions.dim_season(spark).withColumn("season", F.col("season_label"))
    leagues = dimensions.dim_competition(spark).withColumn("league", F.col("competition_name"))
    return _shown(
        counted.join(F.broadcast(seasons), "season").join(F.broadcast(leagues), "league")
        .drop("season", "league")
    )


_FACT = "SELECT * REPLACE (array_to_string(_sources, ',') AS _sources) FROM fct_player_season_stats"


@query(over_chain(_FACT))
def fct_player_season_stats(spark, sf_dir):
    return _shown(built(spark, sf_dir, reads=["dimensions"])["fct_player_season_stats"])


@query(over_chain(_FACT.replace("fct_player", "clean_player")))
def clean_player_season_stats(spark, sf_dir):
    return _shown(built(spark, sf_dir, clean=True, reads=["dimensions"])["fct_player_season_stats"])


@query(
    over_chain(
        """SELECT * REPLACE (strftime(date_of_birth, '%Y-%m-%d') AS date_of_birth)
FROM fct_player_season_valuations"""
    )
)
def fct_player_season_valuations(spark, sf_dir):
    return _shown(built(spark, sf_dir)["fct_player_season_valuations"])


@query(
    over_chain(
        """SELECT t.full_name AS team, s.season_label AS season, sum(goals) AS goals,
  sum(minutes) AS minutes, round(sum(goals) * 90 / sum(minutes), 6) AS goals_per90
FROM fct_player_season_stats f JOIN dim_team t USING (team_key) JOIN dim_season s USING (season_key)
GROUP BY ALL"""
    )
)
def team_goals_per90(spark, sf_dir):
    w = built(spark, sf_dir, reads=["dimensions"])
    fact = w["fct_player_season_stats"]
    names = w["dim_team"].select("team_key", F.col("full_name").alias("team"))
    seasons = w["dim_season"].select("season_key", F.col("season_label").alias("season"))
    totals = fact.groupBy("team_key", "season_key").agg(
        F.sum("goals").alias("goals"), F.sum("minutes").alias("minutes")
    )
    return totals.join(names, "team_key").join(F.broadcast(seasons), "season_key").select(
        "team", "season", "goals", "minutes",
        F.round(F.try_divide(F.col("goals") * 90, F.col("minutes")), 6).alias("goals_per90"),
    )


@query(
    over_chain(
        """SELECT matched, total, round(matched / total, 3) AS match_rate, matched / total >= 0.5 AS passed
FROM (SELECT count(DISTINCT fbref_player_id) FILTER (understat_player_id IS NOT NULL) AS matched,
  (SELECT count(DISTINCT fbref_player_id) FROM stg_fbref__player_season_stats) AS total
  FROM int_player_xref)"""
    )
)
def match_rate(spark, sf_dir):
    w = built(spark, sf_dir, reads=[])
    return checks.match_rate(w["int_player_xref"], w.staged()[0])


@query(oracle.data_tests())
def data_tests(spark, sf_dir):
    w = built(spark, sf_dir, reads=["dimensions", "data_tests"])
    folder = shared_folder(spark)
    models = dict.fromkeys(t.model for t in DATA_TESTS)
    staged = dict(zip((n for n in w if n.startswith("stg_")), w.staged()))
    facts = {n: w.fact_without_measures(n).select(*checks.tested_columns(n)) for n in models if n.startswith("fct_")}
    with ThreadPoolExecutor(len(facts)) as jobs:
        facts = dict(zip(facts, jobs.map(lambda n: written(facts[n], folder, n, codec=CODEC), facts)))
    kept = {**staged, **facts}
    return run_data_tests(DATA_TESTS, {n: kept[n] if n in kept else w[n] for n in models}, lambda df, n: written(df, folder, n))


@query(
    over_chain(
        """SELECT * FROM (
SELECT 'row_count_' || t AS "check", 'ERROR' AS severity, n > 0 AS passed, 'row_count=' || n AS metadata
FROM (SELECT 'raw_fbref__player_season_stats' AS t, count(*) AS n FROM raw_fbref__player_season_stats
  UNION ALL SELECT 'raw_understat__player_season_stats', count(*) FROM raw_understat__player_season_stats
  UNION ALL SELECT 'raw_transfermarkt__player_valuations', count(*)
    FROM raw_transfermarkt__player_valuations)
UNION ALL
SELECT 'player_xref_match_rate', 'WARN', m / t >= 0.5,
  'match_rate=' || round(m / t, 3) || ',matched=' || m || ',total=' || t
FROM (SELECT count(DISTINCT fbref_player_id) FILTER (understat_player_id IS NOT NULL) AS m,
  (SELECT count(DISTINCT fbref_player_id) FROM stg_fbref__player_season_stats) AS t FROM int_player_xref)
UNION ALL
SELECT 'mart_row_counts', 'WARN', s > 0 AND v > 0,
  'fct_player_season_stats=' || s || ',fct_player_season_valuations=' || v
FROM (SELECT (SELECT count(*) FROM fct_player_season_stats) AS s,
  (SELECT count(*) FROM fct_player_season_valuations) AS v))"""
    )
)
def run_checks(spark, sf_dir):
    results = checks.run_checks(built(spark, sf_dir, reads=["dimensions"]))
    entries = F.transform(
        F.array_sort(F.map_entries("metadata")),
        lambda e: F.concat_ws("=", e["key"], e["value"]),
    )
    return results.withColumn("metadata", F.array_join(entries, ","))
