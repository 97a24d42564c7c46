"""Players of three sources brought together by blocked, weighted name matching."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.names import last_token
from touchline.functions.positions import (
    KEEP_SCORE,
    composite_score,
    group_compatibility,
    match_band,
    role_compatibility,
    team_overlap,
)
from touchline.functions.similarity import jaro_winkler, jaro_winkler_bound, letter_mask
from touchline.operators.assignment import assign as assign_groups
from touchline.operators.assignment import give_out
from touchline.operators.latest import first_per_group
from touchline.operators.skew import PAIRS_PER_CELL, spread_join

# Everything that a score depends on. Hub players that agree here have the same best match.
_PROFILE = ["league", "season", "fbref_team_id", "hub_name", "position_mark"]
_BLOCK = ["last_name", "league", "season", "other_team"]
_SCORES = ["composite_score", "name_score", "team_score", "position_score"]
_NO_POSITION = "\x00"

Keep = Callable[[DataFrame, str], DataFrame]


def as_is(df: DataFrame, name: str) -> DataFrame:
    return df


@dataclass(frozen=True)
class _Source:
    prefix: str
    team_column: str
    position_score: Callable[[Column, Column], Column]


UNDERSTAT = _Source("understat", "understat_team_name", group_compatibility)
TRANSFERMARKT = _Source("transfermarkt", "transfermarkt_team_name", role_compatibility)


def _rising(*columns: str) -> list[Column]:
    """Tie-breaks: with them the chosen row does not depend on the order of the input."""
    return [F.col(c).asc_nulls_last() for c in columns]


def main_fbref_rows(stg_fbref: DataFrame) -> DataFrame:
    """One row per player and season: the club with most minutes."""
    rows = stg_fbref.select(
        "fbref_player_id", "season", "league", "fbref_team_id", "position",
        F.col("player_name").alias("hub_name"), "minutes",
    )
    return first_per_group(
        rows,
        ["fbref_player_id", "season"],
        [F.col("minutes").desc_nulls_last(), *_rising("fbref_team_id", "league", "hub_name", "position")],
    ).withColumn("position_mark", F.coalesce("position", F.lit(_NO_POSITION)))


def main_understat_rows(stg_understat: DataFrame) -> DataFrame:
    rows = stg_understat.select(
        F.col("understat_player_id").alias("other_id"), "season", "league",
        F.col("player_name").alias("other_name"), F.col("team_name").alias("other_team"),
        F.col("position_group").alias("other_position"), "minutes",
    )
    return first_per_group(
        rows,
        ["other_id", "season"],
        [
            F.col("minutes").desc_nulls_last(),
            *_rising("other_team", "league", "other_name", "other_position"),
        ],
    )


def main_transfermarkt_rows(stg_transfermarkt: DataFrame) -> DataFrame:
    rows = stg_transfermarkt.select(
        F.col("transfermarkt_player_id").alias("other_id"), "season", "league",
        F.col("player_name").alias("other_name"), F.col("team_name").alias("other_team"),
        F.col("position").alias("other_position"), "market_value_eur", "transfermarkt_team_id",
    )
    return first_per_group(
        rows,
        ["other_id", "season"],
        [
            F.col("market_value_eur").desc_nulls_last(),
            *_rising("transfermarkt_team_id", "league", "other_name", "other_position"),
        ],
    )


def _position_or_null(mark: str = "position_mark") -> Column:
    return F.nullif(F.col(mark), F.lit(_NO_POSITION))


def _wanted(hub: DataFrame, links: DataFrame) -> DataFrame:
    """Distinct hub profiles with each team name the other source may use for their club."""
    return (
        hub.filter(F.col("hub_name") != "")
        .select(*_PROFILE)
        .distinct()
        .join(links, "fbref_team_id")
        .withColumn("last_name", last_token(F.col("hub_name")))
    )


def _offered(other: DataFrame) -> DataFrame:
    """Distinct names of the other source; of players that look alike the least id stands."""
    return (
        other.filter(F.col("other_name") != "")
        .groupBy("league", "season", "other_team", "other_name", "other_position")
        .agg(F.min("other_id").alias("other_id"))
        .withColumn("last_name", last_token(F.col("other_name")))
    )


def _links(xref: DataFrame, source: _Source) -> DataFrame:
    """Club of the hub and a team name of the other source, where the cross-reference has both."""
    return (
        xref.select("fbref_team_id", F.col(source.team_column).alias("other_team"))
        .dropna()
        .distinct()
    )


def _scored(pairs: DataFrame, source: _Source) -> DataFrame:
    # Only pairs of linked teams get here, see ``candidates``.
    return (
        pairs.withColumn("team_score", team_overlap(F.col("other_team")))
        .withColumn(
            "position_score",
            source.position_score(_position_or_null(), F.col("other_position")),
        )
        .withColumn(
            "composite_score",
            composite_score(F.col("name_score"), F.col("team_score"), F.col("position_score")),
        )
    )


def _identical(wanted: DataFrame, offered: DataFrame, source: _Source) -> DataFrame:
    """Profile and least id of the players of the same name, at a linked team, in an agreeing
    position."""
    same_name = offered.withColumn("hub_name", F.col("other_name")).drop("last_name")
    pairs = wanted.join(same_name, ["league", "season", "other_team", "hub_name"])
    agree = source.position_score(_position_or_null(), F.col("other_position")) == 1.0
    return pairs.filter(agree).groupBy(*_PROFILE).agg(F.min("other_id").alias("other_id"))


def _may_be_kept(source: _Source) -> Column:
    """Whether the best score that a pair of names could have is high enough; a little room is left for rounding."""
    bound = jaro_winkler_bound(
        F.col("hub_name"), F.col("other_name"), F.col("hub_letters"), F.col("other_letters"))
    position = source.position_score(_position_or_null(), F.col("other_position"))
    return composite_score(bound, F.lit(1.0), position) >= KEEP_SCORE - 1e-6


def _lettered(names: DataFrame, side: str) -> DataFrame:
    return names.withColumn(f"{side}_letters", letter_mask(f"{side}_name"))


def _similar(
    wanted: DataFrame, offered: DataFrame, source: _Source, pairs_per_cell: int, keep: Keep, bounded: bool = False
) -> DataFrame:
    """Pairs of names that share block and linked team, scored by the similarity UDF.

    With ``bounded`` a pair whose score cannot be kept does not get to the UDF; both sides have their letters then.
    """
    pairs = spread_join(
        wanted, offered, _BLOCK, pairs_per_cell,
        keep=lambda hot: keep(hot, f"{source.prefix}_hot_blocks"),
    )
    if bounded:
        pairs = pairs.filter(_may_be_kept(source)).drop("hub_letters", "other_letters")
    named = pairs.withColumn("name_score", jaro_winkler(F.col("hub_name"), F.col("other_name")))
    return _scored(named, source)


def candidates(
    hub: DataFrame,
    other: DataFrame,
    xref: DataFrame,
    source: _Source,
    pairs_per_cell: int = PAIRS_PER_CELL,
) -> DataFrame:
    """All pairs of distinct profiles and names that can reach the least score.

    Without a link between the teams a score is at most 0.6 + 0.1 = 0.7, below the 0.75 that is
    kept, so the linked team belongs into the join key and not into the score alone.
    """
    wanted = _wanted(hub, _links(xref, source))
    return _similar(wanted, _offered(other), source, pairs_per_cell, as_is)


def best_matches(
    hub: DataFrame,
    other: DataFrame,
    xref: DataFrame,
    source: _Source,
    keep: Keep = as_is,
    pairs_per_cell: int = PAIRS_PER_CELL,
) -> DataFrame:
    """Best kept candidate per hub profile, ties to the least id.

    A pair of equal names at linked teams with agreeing positions has the highest score there
    is, and no other pair has it. Profiles with such a pair are settled by an equi-join on the
    name; only the rest meets its block and goes through the UDF.

    ``keep(df, name)`` may write a relation that is read more than once.
    """
    offered = keep(_lettered(_offered(other), "other"), f"{source.prefix}_names")
    wanted = _wanted(hub, _links(xref, source))
    judged = wanted.join(_identical(wanted, offered, source), _PROFILE, "left")
    # Only profiles that go on to their blocks need their letters.
    letters = F.when(F.col("other_id").isNull(), letter_mask("hub_name"))
    judged = keep(judged.withColumn("hub_letters", letters), f"{source.prefix}_profiles")
    settled = (
        judged.filter(F.col("other_id").isNotNull())
        .select(*_PROFILE, "other_id")
        .withColumn("name_score", F.lit(1.0))
        .withColumn("team_score", F.lit(1.0))
        .withColumn("position_score", F.lit(1.0))
        .withColumn(
            "composite_score", composite_score(F.lit(1.0), F.lit(1.0), F.lit(1.0))
        )
    )
    rest = judged.filter(F.col("other_id").isNull()).drop("other_id")
    kept = _similar(rest, offered, source, pairs_per_cell, keep, bounded=True).filter(
        F.col("composite_score") >= KEEP_SCORE
    )
    # At most one row per profile leaves a map task, whatever the number of pairs. Settled profiles, which come once for
    # each linked team, go the same way, so that the result is dealt by profile and need not move again.
    return first_per_group(
        settled.unionByName(kept.select(*_PROFILE, *_SCORES, "other_id")),
        _PROFILE,
        [F.col("composite_score").desc(), F.col("other_id").asc_nulls_last()],
    )


def assigned_matches(
    hub: DataFrame,
    other: DataFrame,
    xref: DataFrame,
    overrides: DataFrame,
    source: _Source,
    keep: Keep = as_is,
    pairs_per_cell: int = PAIRS_PER_CELL,
) -> DataFrame:
    """Match per hub player and season in which each id of the other source is given once.

    Candidates are those of ``best_matches``. A player who does not get the best one gets the next that is free, and
    nobody stays without a match who has a free candidate. Players and ids of a manual match take no part. Players of
    one profile, and ids of one name, are a group: pairs are between groups, and the members go together in order of
    their ids.
    """
    manual_id = f"{source.prefix}_player_id"
    fixed = hub.join(overrides.select("fbref_player_id", F.col(manual_id).alias("other_id")).dropna(), "fbref_player_id")
    fixed = keep(fixed.select("fbref_player_id", "season", "other_id"), f"{source.prefix}_manual")
    hub = hub.filter(F.col("hub_name") != "").join(fixed.select("fbref_player_id", "season"), ["fbref_player_id", "season"], "left_anti")
    other = other.filter(F.col("other_name") != "").join(fixed.select("other_id", "season"), ["other_id", "season"], "left_anti")
    named = ["league", "season", "other_team", "other_name", "other_position"]
    group_l, group_r = F.struct(*_PROFILE).alias("l"), F.struct(*named).alias("r")

    def placed(rows: DataFrame, group: Column, side: str, id_column: str) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(side).orderBy(id_column)) - 1
        return rows.select(group, id_column, *(["season"] if side == "l" else [])).withColumn(f"{side}_at", place)

    wanted = keep(_lettered(_wanted(hub, _links(xref, source)), "hub"), f"{source.prefix}_profiles")
    offered = keep(_lettered(_offered(other), "other"), f"{source.prefix}_names")
    pairs = _similar(wanted, offered, source, pairs_per_cell, keep, bounded=True)
    kept = pairs.filter(F.col("composite_score") >= KEEP_SCORE).select(
        group_l, group_r, F.col("composite_score").alias("score"), "name_score", "team_score", "position_score")
    size_l = hub.select(group_l).groupBy("l").agg(F.count(F.lit(1)).alias("l_size"))
    size_r = other.select(group_r).groupBy("r").agg(F.count(F.lit(1)).alias("r_size"))
    settled = assign_groups(kept.join(size_l, "l").join(size_r, "r"), keep, f"{source.prefix}_assignment")
    given = give_out(settled, placed(hub, group_l, "l", "fbref_player_id"), placed(other, group_r, "r", "other_id"))
    return given.withColumnRenamed("score", "composite_score")


def check_overrides(overrides: DataFrame) -> DataFrame:
    """Override rows whose player id is given more than once; they would multiply players."""
    return overrides.groupBy("fbref_player_id").count().filter(F.col("count") > 1)


def player_xref(
    hub: DataFrame, by_name: DataFrame, by_value: DataFrame, overrides: DataFrame, per_player: bool = False
) -> DataFrame:
    """One row per FBref player and season with the matched ids, scores and status.

    ``hub`` are the main FBref rows, ``by_name`` and ``by_value`` the best matches with Understat
    and Transfermarkt, one per profile or, with ``per_player``, one per player and season.
    """
    keys = ["fbref_player_id", "season"] if per_player else _PROFILE
    understat = by_name.select(
        *keys,
        F.col("other_id").alias("_understat_id"),
        F.col("composite_score").alias("confidence"),
        "name_score",
        "team_score",
        "position_score",
    )
    transfermarkt = by_value.select(
        *keys,
        F.col("other_id").alias("_transfermarkt_id"),
        F.col("composite_score").alias("transfermarkt_confidence"),
    )
    manual = overrides.select(
        "fbref_player_id",
        F.col("understat_player_id").alias("_manual_understat"),
        F.col("transfermarkt_player_id").alias("_manual_transfermarkt"),
        F.col("canonical_player_id").alias("_manual_canonical"),
        F.lit(True).alias("_manual"),
    )
    status = (
        F.when(F.col("_manual"), "manual_override")
        .when(F.col("_understat_id").isNotNull(), match_band(F.col("confidence")))
        .otherwise("unmatched")
    )
    # The two match relations have one row per key. They are put together first, so that the
    # hub, where many players may share a profile, takes part in a single join that Spark can
    # split when one profile is hot.
    matches = understat.join(transfermarkt, keys, "full")
    return (
        hub.select("fbref_player_id", *_PROFILE)
        .join(matches, keys, "left")
        .join(manual, "fbref_player_id", "left")
        .select(
            F.coalesce("_manual_canonical", "fbref_player_id").alias("canonical_player_id"),
            "fbref_player_id",
            F.coalesce("_manual_understat", "_understat_id").alias("understat_player_id"),
            F.coalesce("_manual_transfermarkt", "_transfermarkt_id").alias(
                "transfermarkt_player_id"
            ),
            "league",
            "season",
            "confidence",
            "name_score",
            "team_score",
            "position_score",
            "transfermarkt_confidence",
            status.alias("match_status"),
        )
    )


def resolve_players(
    stg_fbref: DataFrame,
    stg_understat: DataFrame,
    stg_transfermarkt: DataFrame,
    xref: DataFrame,
    overrides: DataFrame,
    keep: Keep = as_is,
    pairs_per_cell: int = PAIRS_PER_CELL,
    one_to_one: bool = False,
    assign: bool = False,
) -> DataFrame:
    """The whole player cross-reference from staging relations.

    ``one_to_one`` leaves each id of another source to its best player, ``assign`` gives ids out as an assignment.

    The two sources do not depend on each other; where ``keep`` writes relations, their jobs run
    side by side. Overrides that name a player twice are refused: they would multiply rows.
    """
    twice = [row["fbref_player_id"] for row in check_overrides(overrides).limit(5).collect()]
    if twice:
        raise ValueError(f"players with more than one override: {', '.join(map(str, sorted(map(str, twice))))}")
    hub = keep(main_fbref_rows(stg_fbref), "main_fbref_rows")
    others = {
        UNDERSTAT: main_understat_rows(stg_understat),
        TRANSFERMARKT: main_transfermarkt_rows(stg_transfermarkt),
    }

    def match(source: _Source) -> DataFrame:
        if assign:
            return assigned_matches(hub, others[source], xref, overrides, source, keep, pairs_per_cell)
        return best_matches(hub, others[source], xref, source, keep, pairs_per_cell)

    with ThreadPoolExecutor(len(others)) as jobs:
        by_name, by_value = jobs.map(match, others)
    resolved = player_xref(hub, by_name, by_value, overrides, per_player=assign)
    return each_id_once(resolved) if one_to_one else resolved


def each_id_once(resolved: DataFrame) -> DataFrame:
    """Leave each id of another source to one player of a season: a manual match, else the best score.

    The others lose the id with its scores. Rows without an id are groups of their own.
    """
    lost = {
        "understat_player_id": ["confidence", "name_score", "team_score", "position_score"],
        "transfermarkt_player_id": ["transfermarkt_confidence"],
    }
    manual = F.col("match_status") == "manual_override"
    for other, scores in lost.items():
        group = F.coalesce(other, F.concat(F.lit("\0"), "fbref_player_id"))
        order = [manual.desc(), F.col(scores[0]).desc_nulls_last(), F.col("fbref_player_id").asc_nulls_last()]
        first = F.row_number().over(Window.partitionBy(group, "season").orderBy(*order)) == 1
        resolved = resolved.withColumn("_first", first)
        kept = {c: F.when(F.col("_first"), F.col(c)) for c in [other, *scores]}
        if other == "understat_player_id":
            kept["match_status"] = F.when(F.col("_first") | manual, F.col("match_status")).otherwise("unmatched")
        resolved = resolved.withColumns(kept).drop("_first")
    return resolved
