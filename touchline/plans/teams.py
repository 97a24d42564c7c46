"""Teams of three sources brought together under one canonical name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.keys import surrogate_key
from touchline.functions.names import ascii_team_name


def _canonical(teams: DataFrame, aliases: DataFrame, source: str, name: str) -> DataFrame:
    """Add ``canonical_team_name``: the alias of this source if there is one, else the name."""
    own = aliases.filter(F.col("source") == source).select(
        F.col("source_team_name").alias(name), "league", F.col("canonical_team_name").alias("_alias")
    )
    return teams.join(own, [name, "league"], "left").withColumn(
        "canonical_team_name", F.coalesce("_alias", name)
    ).drop("_alias")


def _only_names(teams: DataFrame) -> DataFrame:
    """Clubs of a source (canonical_team_name, league) with their affix-free key, and whether the key is theirs alone."""
    clubs = teams.select("canonical_team_name", "league").distinct()
    keyed = clubs.withColumn("_key", ascii_team_name(F.col("canonical_team_name")))
    counted = keyed.filter("_key <> ''").groupBy("league", "_key").agg(F.count(F.lit(1)).alias("_n"))
    return keyed.join(counted, ["league", "_key"]).withColumn("_alone", F.col("_n") == 1).drop("_n")


def _by_affix_free_name(hub: DataFrame, other: DataFrame) -> DataFrame:
    """``other`` with the canonical names of the hub, where the exact name is not one of them but the key is.

    Clubs that have an exact counterpart keep it. A key that names two clubs of either source in a league is refused.
    """
    keys = ["canonical_team_name", "league"]
    theirs, ours = _only_names(other), _only_names(hub)
    open_hub = ours.join(theirs.select(*keys), keys, "left_anti").filter("_alone")
    open_other = theirs.join(ours.select(*keys), keys, "left_anti").filter("_alone")
    found = open_other.join(
        open_hub.select(F.col("canonical_team_name").alias("_hub_name"), "league", "_key"), ["league", "_key"]
    ).select(*keys, "_hub_name")
    return other.join(found, keys, "left").withColumn(
        "canonical_team_name", F.coalesce("_hub_name", "canonical_team_name")
    ).drop("_hub_name")


def team_xref(
    stg_fbref: DataFrame,
    stg_understat: DataFrame,
    stg_transfermarkt: DataFrame,
    aliases: DataFrame,
    ladder: bool = False,
) -> DataFrame:
    """One row per FBref team with its counterparts.

    The distinct team lists are pre-aggregated on the map side, so player rows never travel.
    No broadcast hints: list sizes follow the data, and Spark broadcasts a side by its size.

    With ``ladder``, clubs that neither an alias nor the exact name brings together are tried by their name in ASCII
    without club prefix and suffix.
    """
    fbref = _canonical(
        stg_fbref.select("fbref_team_id", F.col("team_name").alias("fbref_team_name"), "league")
        .distinct(),
        aliases, "fbref", "fbref_team_name",
    )
    understat = _canonical(
        stg_understat.select(F.col("team_name").alias("understat_team_name"), "league").distinct(),
        aliases, "understat", "understat_team_name",
    )
    transfermarkt = _canonical(
        stg_transfermarkt.select(
            "transfermarkt_team_id", F.col("team_name").alias("transfermarkt_team_name"), "league"
        ).distinct(),
        aliases, "transfermarkt", "transfermarkt_team_name",
    )
    if ladder:
        understat, transfermarkt = (_by_affix_free_name(fbref, other) for other in (understat, transfermarkt))
    keys = ["canonical_team_name", "league"]
    return (
        fbref.join(understat, keys, "left")
        .join(transfermarkt, keys, "left")
        .select(
            surrogate_key("canonical_team_name", "league").alias("canonical_team_id"),
            "fbref_team_id",
            "fbref_team_name",
            "understat_team_name",
            "transfermarkt_team_id",
            "transfermarkt_team_name",
            "canonical_team_name",
            "league",
        )
    )
