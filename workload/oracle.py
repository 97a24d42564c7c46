"""The relations of the warehouse as SQL for the second engine, over the derived raw tables.

Written for the checking engine and from the meaning of each relation: matching here is the plain
all-candidates form, so that the shortcuts of the DataFrame code are checked and not repeated.
"""

from __future__ import annotations

import re

from touchline.operators.quality import DataTest
from touchline.plans.checks import DATA_TESTS
from workload import league


def key(*cols: str) -> str:
    mark = "'_dbt_utils_surrogate_key_null_'"
    return "md5(" + " || '-' || ".join(f"coalesce({c}::VARCHAR, {mark})" for c in cols) + ")"


def norm(c: str) -> str:
    return f"trim(lower(strip_accents({c})))"


def _first(relation: str, keys: str, order: str, where: str = "TRUE") -> str:
    return (
        f"SELECT * FROM {relation} WHERE {where} "
        f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1"
    )


def _position_points(code: str, other: str, table: dict[str, list[str]]) -> str:
    hits = " OR ".join(
        f"(contains({code}, '{short}') AND {other} IN ({', '.join(repr(v) for v in values)}))"
        for short, values in table.items()
    )
    return f"CASE WHEN {code} IS NULL OR {other} IS NULL THEN 0.5::DOUBLE WHEN {hits} THEN 1::DOUBLE ELSE 0::DOUBLE END"


_GROUPS = {"FW": ["Forward"], "MF": ["Midfielder"], "DF": ["Defender"], "GK": ["Goalkeeper"]}
_ROLES = {
    "FW": ["Centre-Forward", "Left Winger", "Right Winger", "Second Striker"],
    "MF": ["Central Midfield", "Attacking Midfield", "Defensive Midfield", "Left Midfield",
           "Right Midfield"],
    "DF": ["Centre-Back", "Left-Back", "Right-Back"],
    "GK": ["Goalkeeper"],
}


def _pairs(others: str, team: str, table: dict[str, list[str]]) -> str:
    """All pairs of a last name, league and season with their three scores."""
    return f"""
SELECT *, 0.6::DOUBLE * name_score + 0.3::DOUBLE * team_score + 0.1::DOUBLE * position_score AS score
FROM (
  SELECT h.fbref_player_id, h.season, h.league, o.id, h.player_name AS hub_name,
    o.player_name AS other_name, h.fbref_team_id, h.position AS mark, o.team_name AS other_team,
    o.position AS other_position,
    jaro_winkler_similarity(h.player_name, o.player_name) AS name_score,
    (EXISTS (SELECT 1 FROM int_team_xref x WHERE x.fbref_team_id = h.fbref_team_id
      AND x.{team} = o.team_name))::INT::DOUBLE AS team_score,
    {_position_points('h.position', 'o.position', table)} AS position_score
  FROM hub h JOIN {others} o
    ON regexp_extract(h.player_name, '[^ ]*$') = regexp_extract(o.player_name, '[^ ]*$')
    AND h.league = o.league AND h.season = o.season
)"""


def _mapped(stage: str, source: str, extra: str = "") -> str:
    return f"""
SELECT DISTINCT {extra} t.team_name, t.league,
  coalesce(a.canonical_team_name, t.team_name) AS canonical
FROM {stage} t LEFT JOIN aliases a
  ON a.source = '{source}' AND a.source_team_name = t.team_name AND a.league = t.league"""


_ROUNDS = 14


def _assigned(source: str, sides: str) -> dict[str, str]:
    """Rounds of mutual first choices, player by player; ``sides`` are the columns that order pairs of one score."""
    manual = f"{source}_player_id"
    c = {f"{source}_e0": f"""
SELECT p.*, row_number() OVER (ORDER BY score DESC, {sides}, fbref_player_id, id) AS o FROM {source}_pairs p
WHERE score >= 0.75 AND NOT EXISTS (
  SELECT 1 FROM overrides v WHERE v.{manual} IS NOT NULL AND (v.fbref_player_id = p.fbref_player_id OR (v.{manual} = p.id
    AND EXISTS (SELECT 1 FROM hub h WHERE h.fbref_player_id = v.fbref_player_id AND h.season = p.season))))"""}
    for k in range(_ROUNDS):
        c[f"{source}_m{k}"] = f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY fbref_player_id, season ORDER BY o) AS a,
  row_number() OVER (PARTITION BY id, season ORDER BY o) AS b FROM {source}_e{k}) WHERE a = 1 AND b = 1"""
        c[f"{source}_e{k + 1}"] = f"""
SELECT e.* FROM {source}_e{k} e ANTI JOIN {source}_m{k} m ON m.fbref_player_id = e.fbref_player_id AND m.season = e.season
ANTI JOIN {source}_m{k} n ON n.id = e.id AND n.season = e.season"""
    c[f"{source}_assigned"] = " UNION ALL ".join(f"SELECT * FROM {source}_m{k}" for k in range(_ROUNDS))
    return c


def _chain() -> dict[str, str]:
    c: dict[str, str] = {
        "clubs": league.CLUBS,
        "players": league.PLAYERS,
        "lines": league.LINES,
        "raw_fbref__player_season_stats": league.RAW_FBREF,
        "raw_understat__player_season_stats": league.RAW_UNDERSTAT,
        "raw_transfermarkt__player_valuations": league.RAW_TRANSFERMARKT,
        "aliases": league.ALIASES,
        "overrides": league.OVERRIDES,
    }
    c = {name: text.format(lines="lines", clubs="clubs", players="players") for name, text in c.items()}
    common = f"""player_name AS player_name_raw, {norm('player_name')} AS player_name,
  team_name AS team_name_raw, {norm('team_name')} AS team_name"""
    c["stg_fbref__player_season_stats"] = f"""
SELECT {key('player_id', 'team_id', '_season')} AS player_season_team_id,
  player_id AS fbref_player_id, team_id AS fbref_team_id, league, _season AS season, {common},
  nationality, position,
  CASE WHEN contains(age, '-') THEN try_cast(str_split(age, '-')[1] AS INT) END AS age_years,
  age AS age_raw, games, games_starts, minutes, goals, assists, goals_pens AS goals_non_penalty,
  pens_made AS penalties_scored, pens_att AS penalties_attempted, cards_yellow AS yellow_cards,
  cards_red AS red_cards, xg, npxg, xg_assist, goals_per90, assists_per90, goals_assists_per90,
  xg_per90, xg_assist_per90, is_multi_team_total, is_multi_team_row
FROM raw_fbref__player_season_stats
WHERE is_multi_team_total = FALSE AND coalesce(minutes, 1) > 0"""
    c["stg_understat__player_season_stats"] = f"""
SELECT {key('player_id', 'team_name', '_season')} AS player_season_team_id,
  player_id AS understat_player_id, _season AS season, {common}, league,
  position AS position_raw,
  CASE WHEN regexp_matches(position, '^GK( |$)') THEN 'Goalkeeper'
    WHEN regexp_matches(position, '^F( |$)') THEN 'Forward'
    WHEN regexp_matches(position, '^M( |$)') THEN 'Midfielder'
    WHEN regexp_matches(position, '^D( |$)') THEN 'Defender'
    WHEN position = 'Sub' THEN 'Substitute' ELSE position END AS position_group,
  games, minutes, goals, assists, npg, xg, xg_assist, npxg, xg_chain, xg_buildup, shots,
  key_passes, yellow_cards, red_cards
FROM raw_understat__player_season_stats WHERE coalesce(minutes, 1) > 0"""
    c["stg_transfermarkt__player_valuations"] = f"""
SELECT {key('player_id', 'team_id', '_season')} AS player_valuation_id,
  player_id AS transfermarkt_player_id, team_id AS transfermarkt_team_id, _season AS season,
  {common}, league, position, nationality,
  coalesce(try_strptime(date_of_birth, '%b %d, %Y')::DATE, try_cast(date_of_birth AS DATE))
    AS date_of_birth,
  age AS age_years, market_value_eur
FROM ({_first('raw_transfermarkt__player_valuations', 'player_id, team_id, _season',
              '_ingested_at DESC, league, _source_url, player_name')})"""
    c["fbref_teams"] = _mapped("stg_fbref__player_season_stats", "fbref", "fbref_team_id,")
    c["understat_teams"] = _mapped("stg_understat__player_season_stats", "understat")
    c["transfermarkt_teams"] = _mapped(
        "stg_transfermarkt__player_valuations", "transfermarkt", "transfermarkt_team_id,"
    )
    c["int_team_xref"] = f"""
SELECT {key('f.canonical', 'f.league')} AS canonical_team_id, f.fbref_team_id,
  f.team_name AS fbref_team_name, u.team_name AS understat_team_name, t.transfermarkt_team_id,
  t.team_name AS transfermarkt_team_name, f.canonical AS canonical_team_name, f.league
FROM fbref_teams f LEFT JOIN understat_teams u USING (canonical, league)
LEFT JOIN transfermarkt_teams t USING (canonical, league)"""
    c["hub"] = _first("stg_fbref__player_season_stats", "fbref_player_id, season",
                      "minutes DESC NULLS LAST, fbref_team_id")
    c["main_understat"] = (
        "SELECT *, understat_player_id AS id, position_group AS position FROM ("
        + _first("stg_understat__player_season_stats", "understat_player_id, season",
                 "minutes DESC NULLS LAST, team_name") + ")"
    )
    c["main_transfermarkt"] = (
        "SELECT *, transfermarkt_player_id AS id FROM ("
        + _first("stg_transfermarkt__player_valuations", "transfermarkt_player_id, season",
                 "market_value_eur DESC NULLS LAST, transfermarkt_team_id, league") + ")"
    )
    c["understat_pairs"] = _pairs("main_understat", "understat_team_name", _GROUPS)
    c["transfermarkt_pairs"] = _pairs("main_transfermarkt", "transfermarkt_team_name", _ROLES)
    for source in ("understat", "transfermarkt"):
        c[f"{source}_best"] = _first(
            f"{source}_pairs", "fbref_player_id, season", "score DESC, id", "score >= 0.75"
        )
    c["int_player_xref"] = """
SELECT coalesce(o.canonical_player_id, h.fbref_player_id) AS canonical_player_id,
  h.fbref_player_id, coalesce(o.understat_player_id, u.id) AS understat_player_id,
  coalesce(o.transfermarkt_player_id, t.id) AS transfermarkt_player_id, h.league, h.season,
  u.score AS confidence, u.name_score, u.team_score, u.position_score,
  t.score AS transfermarkt_confidence,
  CASE WHEN o.fbref_player_id IS NOT NULL THEN 'manual_override' WHEN u.id IS NULL THEN 'unmatched'
    WHEN u.score >= 0.9::DOUBLE THEN 'auto_matched' ELSE 'review_needed' END AS match_status
FROM hub h LEFT JOIN understat_best u USING (fbref_player_id, season)
LEFT JOIN transfermarkt_best t USING (fbref_player_id, season)
LEFT JOIN overrides o USING (fbref_player_id)"""
    c["dim_season"] = f"""
SELECT {key('season_label')} AS season_key, season_label,
  make_date(season_label[1:4]::INT, 8, 1) AS start_date,
  make_date(season_label[6:9]::INT, 6, 30) AS end_date
FROM (SELECT unnest(['2023-2024', '2024-2025', '2025-2026']) AS season_label)"""
    c["dim_competition"] = f"""
SELECT {key('competition_name')} AS competition_key, competition_name, country, 1 AS tier
FROM (SELECT unnest(['Premier League', 'La Liga', 'Bundesliga', 'Serie A', 'Ligue 1'])
  AS competition_name, unnest(['England', 'Spain', 'Germany', 'Italy', 'France']) AS country)"""
    c["dim_team"] = f"""
SELECT {key('coalesce(x.canonical_team_id, s.fbref_team_id)')} AS team_key,
  coalesce(x.canonical_team_id, s.fbref_team_id) AS canonical_team_id,
  s.team_name_raw AS full_name, s.team_name AS short_name, s.league, s.fbref_team_id,
  x.understat_team_name AS understat_team_id, x.transfermarkt_team_id
FROM ({_first('stg_fbref__player_season_stats', 'fbref_team_id', 'team_name_raw, league')}) s
LEFT JOIN int_team_xref x ON x.fbref_team_id = s.fbref_team_id"""
    c["dim_player"] = f"""
SELECT {key('x.canonical_player_id')} AS player_key, x.canonical_player_id,
  s.player_name_raw AS full_name, s.player_name AS short_name, s.nationality,
  s.position AS primary_position, s.age_years, s.fbref_player_id,
  x.understat_player_id AS understat_id, x.transfermarkt_player_id AS transfermarkt_id
FROM ({_first('stg_fbref__player_season_stats', 'fbref_player_id',
              'season DESC, minutes DESC NULLS LAST, fbref_team_id')}) s
JOIN ({_first('int_player_xref', 'fbref_player_id', 'season DESC, canonical_player_id')}) x
  USING (fbref_player_id)"""
    c["fct_player_season_stats"] = f"""
SELECT {key('p.player_key', 't.team_key', 'd.season_key')} AS player_season_stats_key,
  p.player_key, t.team_key, c.competition_key, d.season_key,
  f.games, f.games_starts, f.minutes, f.goals, f.assists, f.goals_non_penalty, f.penalties_scored,
  f.penalties_attempted, f.yellow_cards, f.red_cards, f.xg AS fbref_xg, f.npxg AS fbref_npxg,
  f.xg_assist AS fbref_xg_assist, f.goals_per90, f.assists_per90, f.goals_assists_per90,
  f.xg_per90, f.xg_assist_per90, e.xg AS understat_xg, e.xg_assist AS understat_xg_assist,
  e.npxg AS understat_npxg, e.xg_chain, e.xg_buildup, e.shots AS understat_shots, e.key_passes,
  if(e.fbref_player_id IS NULL, ['fbref'], ['fbref', 'understat']) AS _sources
FROM stg_fbref__player_season_stats f
JOIN dim_player p ON p.canonical_player_id = f.fbref_player_id
JOIN dim_team t ON t.fbref_team_id = f.fbref_team_id
JOIN dim_season d ON d.season_label = f.season
JOIN dim_competition c ON c.competition_name = f.league
LEFT JOIN (
  SELECT x.fbref_player_id, u.* FROM stg_understat__player_season_stats u
  JOIN int_player_xref x USING (understat_player_id, season)
  JOIN int_team_xref k ON k.understat_team_name = u.team_name
) e ON e.fbref_player_id = f.fbref_player_id AND e.season = f.season"""
    c["clean_player_season_stats"] = (
        c["fct_player_season_stats"]
        .replace("p.canonical_player_id = f.fbref_player_id", "p.fbref_player_id = f.fbref_player_id")
        .replace("SELECT x.fbref_player_id, u.*", "SELECT x.fbref_player_id, k.fbref_team_id, u.*")
        .replace("k.understat_team_name = u.team_name", "k.understat_team_name = u.team_name AND k.league = u.league")
        .replace("e.season = f.season", "e.season = f.season AND e.fbref_team_id = f.fbref_team_id")
    )
    c["single_player_xref"] = """
SELECT canonical_player_id, fbref_player_id, CASE WHEN own THEN understat_player_id END AS understat_player_id,
  CASE WHEN own_value THEN transfermarkt_player_id END AS transfermarkt_player_id, league, season,
  CASE WHEN own THEN confidence END AS confidence, CASE WHEN own THEN name_score END AS name_score,
  CASE WHEN own THEN team_score END AS team_score, CASE WHEN own THEN position_score END AS position_score,
  CASE WHEN own_value THEN transfermarkt_confidence END AS transfermarkt_confidence,
  CASE WHEN own OR match_status = 'manual_override' THEN match_status ELSE 'unmatched' END AS match_status
FROM (SELECT *,
  understat_player_id IS NULL OR row_number() OVER (PARTITION BY understat_player_id, season ORDER BY
    match_status = 'manual_override' DESC, confidence DESC NULLS LAST, fbref_player_id) = 1 AS own,
  transfermarkt_player_id IS NULL OR row_number() OVER (PARTITION BY transfermarkt_player_id, season ORDER BY
    match_status = 'manual_override' DESC, transfermarkt_confidence DESC NULLS LAST, fbref_player_id) = 1 AS own_value
  FROM int_player_xref)"""
    order = "league, season, fbref_team_id, hub_name, mark NULLS FIRST, other_team, other_name, other_position NULLS FIRST"
    for source in ("understat", "transfermarkt"):
        c |= _assigned(source, order)
    c["assigned_player_xref"] = c["int_player_xref"].replace("understat_best", "understat_assigned").replace(
        "transfermarkt_best", "transfermarkt_assigned")
    c["fct_player_season_valuations"] = f"""
SELECT {key('p.player_key', 't.team_key', 'd.season_key')} AS valuation_key,
  p.player_key, t.team_key, d.season_key, c.competition_key, v.market_value_eur, v.date_of_birth,
  v.nationality
FROM stg_transfermarkt__player_valuations v
JOIN int_player_xref x USING (transfermarkt_player_id, season)
LEFT JOIN int_team_xref k ON k.transfermarkt_team_name = v.team_name AND k.league = v.league
JOIN dim_player p ON p.canonical_player_id = x.canonical_player_id
JOIN dim_team t ON t.canonical_team_id = k.canonical_team_id
JOIN dim_season d ON d.season_label = v.season
JOIN dim_competition c ON c.competition_name = v.league"""
    return c


CHAIN = _chain()


def over_chain(select: str) -> str:
    """A query with the relations of the warehouse that it needs in scope."""
    needed, text = set(), select
    for name in reversed(CHAIN):
        if re.search(rf"\b{name}\b", text):
            needed.add(name)
            text += CHAIN[name]
    parts = [f"{n} AS MATERIALIZED ({body})" for n, body in CHAIN.items() if n in needed]
    return "WITH " + ",\n".join(parts) + "\n" + select


def _failures(t: DataTest) -> str:
    c, o = t.column, t.options
    if t.kind == "unique":
        return (
            f"SELECT count(*) FROM (SELECT {c} FROM {t.model} WHERE {c} IS NOT NULL "
            f"GROUP BY {c} HAVING count(*) > 1)"
        )
    if t.kind == "relationships":
        bad = f"{c} IS NOT NULL AND {c} NOT IN (SELECT {o['field']} FROM {o['to']})"
    elif t.kind == "not_null":
        bad = f"{c} IS NULL"
    elif t.kind == "accepted_values":
        bad = f"{c} NOT IN ({', '.join(repr(v) for v in o['values'])})"
    elif t.kind == "xg_per_shot_range":
        bad = f"{o['shots_column']} > 0 AND {c} / {o['shots_column']} > 1"
    else:
        bad = f"{c} < {o['min_value']}"
        if "max_value" in o:
            bad += f" OR {c} > {o['max_value']}"
    return f"SELECT count(*) FROM {t.model} WHERE {bad}"


def data_tests() -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{t.model}' AS model, '{t.column}' AS \"column\", '{t.kind}' AS test, "
        f"({_failures(t)}) AS failures"
        for t in DATA_TESTS
    )
    return over_chain(f"SELECT *, failures = 0 AS passed FROM ({rows})")
