"""The data tests of the warehouse and the table checks that run after a build."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.operators.quality import DataTest
from touchline.sources.seeds import LEAGUES

MATCH_RATE_FLOOR = 0.5

# The columns of each relation that are tested, by kind of test.
_STATUSES = ["auto_matched", "review_needed", "manual_override", "unmatched"]
_NOT_NULL = {
    "stg_fbref__player_season_stats": "player_season_team_id fbref_player_id fbref_team_id league "
    "season player_name team_name",
    "stg_understat__player_season_stats": "player_season_team_id understat_player_id league "
    "season player_name team_name",
    "stg_transfermarkt__player_valuations": "player_valuation_id transfermarkt_player_id "
    "transfermarkt_team_id league season player_name team_name",
    "int_team_xref": "canonical_team_id fbref_team_id canonical_team_name league",
    "int_player_xref": "canonical_player_id fbref_player_id match_status",
    "dim_season": "season_key season_label",
    "dim_competition": "competition_key competition_name",
    "dim_team": "team_key canonical_team_id full_name",
    "dim_player": "player_key canonical_player_id full_name",
    "fct_player_season_stats": "player_season_stats_key player_key team_key competition_key "
    "season_key",
    "fct_player_season_valuations": "valuation_key player_key team_key season_key "
    "competition_key",
}
_UNIQUE = {
    "stg_fbref__player_season_stats": "player_season_team_id",
    "stg_understat__player_season_stats": "player_season_team_id",
    "stg_transfermarkt__player_valuations": "player_valuation_id",
    "int_team_xref": "canonical_team_id fbref_team_id",
    "dim_season": "season_key season_label",
    "dim_competition": "competition_key competition_name",
    "dim_team": "team_key canonical_team_id",
    "dim_player": "player_key canonical_player_id",
    "fct_player_season_stats": "player_season_stats_key",
    "fct_player_season_valuations": "valuation_key",
}
_LEAGUE_IN_SCOPE = [
    "stg_fbref__player_season_stats", "stg_understat__player_season_stats",
    "stg_transfermarkt__player_valuations",
]
_NOT_NEGATIVE = {
    "stg_fbref__player_season_stats": "goals assists xg",
    "stg_understat__player_season_stats": "shots xg xg_assist xg_chain xg_buildup goals",
    "stg_transfermarkt__player_valuations": "market_value_eur",
    "fct_player_season_stats": "goals understat_xg xg_chain xg_buildup",
    "fct_player_season_valuations": "market_value_eur",
}
_AT_LEAST_ONE = {
    "stg_fbref__player_season_stats": "minutes",
    "stg_understat__player_season_stats": "minutes",
    "fct_player_season_stats": "minutes",
}
_SCORES = {"int_player_xref": "confidence transfermarkt_confidence"}
_PARENTS = {
    "player_key": "dim_player",
    "team_key": "dim_team",
    "competition_key": "dim_competition",
    "season_key": "dim_season",
}


def _each(table: Mapping[str, str], kind: str, **options) -> list[DataTest]:
    return [DataTest(m, c, kind, options) for m, cs in table.items() for c in cs.split()]


DATA_TESTS: list[DataTest] = [
    *_each(_NOT_NULL, "not_null"),
    *_each(_UNIQUE, "unique"),
    *[DataTest(m, "league", "accepted_values", {"values": LEAGUES}) for m in _LEAGUE_IN_SCOPE],
    DataTest("int_player_xref", "match_status", "accepted_values", {"values": _STATUSES}),
    *_each(_NOT_NEGATIVE, "accepted_range", min_value=0),
    *_each(_AT_LEAST_ONE, "accepted_range", min_value=1),
    *_each(_SCORES, "accepted_range", min_value=0.75, max_value=1.0),
    DataTest(
        "stg_understat__player_season_stats", "xg", "xg_per_shot_range", {"shots_column": "shots"}
    ),
    DataTest(
        "fct_player_season_stats", "understat_xg", "xg_per_shot_range",
        {"shots_column": "understat_shots"},
    ),
    *[
        DataTest(fact, key, "relationships", {"to": parent, "field": key})
        for fact in ("fct_player_season_stats", "fct_player_season_valuations")
        for key, parent in _PARENTS.items()
    ],
]


def tested_columns(model: str) -> list[str]:
    """The columns of a relation that ``DATA_TESTS`` read."""
    own = [t for t in DATA_TESTS if t.model == model]
    return list(dict.fromkeys([t.column for t in own] + [t.options["shots_column"] for t in own if "shots_column" in t.options]))


def match_rate(player_xref: DataFrame, stg_fbref: DataFrame) -> DataFrame:
    """One row: matched and all distinct players, their ratio, and whether it reaches the floor.

    The two counts are two one-row aggregates put under each other, not joined.
    """
    matched = player_xref.filter(F.col("understat_player_id").isNotNull()).agg(
        F.countDistinct("fbref_player_id").alias("matched")
    )
    total = stg_fbref.agg(F.countDistinct("fbref_player_id").alias("total"))
    counts = matched.unionByName(total, allowMissingColumns=True).agg(
        F.max("matched").alias("matched"), F.max("total").alias("total")
    )
    rate = F.try_divide("matched", "total")
    return counts.select(
        "matched",
        "total",
        F.round(rate, 3).alias("match_rate"),
        F.coalesce(rate >= MATCH_RATE_FLOOR, F.lit(False)).alias("passed"),
    )


def row_counts(tables: Mapping[str, DataFrame | None], names: list[str]) -> DataFrame:
    """table, row_count; a table that does not exist counts as empty."""
    spark = SparkSession.getActiveSession()
    out = spark.createDataFrame([], "table string, row_count bigint")
    for name in names:
        df = tables.get(name)
        if df is None:
            one = spark.createDataFrame([(name, 0)], "table string, row_count bigint")
        else:
            one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table"), "row_count"
            )
        out = out.unionByName(one)
    return out


class CheckFailed(Exception):
    """A check of severity ERROR did not pass."""


_RAW = [
    "raw_fbref__player_season_stats",
    "raw_understat__player_season_stats",
    "raw_transfermarkt__player_valuations",
]
_FACTS = ["fct_player_season_stats", "fct_player_season_valuations"]


def run_checks(tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """check, severity, passed, metadata – raw tables filled, match rate, facts filled."""
    raw = row_counts(tables, _RAW).select(
        F.concat(F.lit("row_count_"), "table").alias("check"),
        F.lit("ERROR").alias("severity"),
        (F.col("row_count") > 0).alias("passed"),
        F.create_map(F.lit("row_count"), F.col("row_count").cast("string")).alias("metadata"),
    )
    # A warehouse counts its facts without working out their measures.
    counted = {n: tables.fact_without_measures(n) for n in _FACTS} if hasattr(tables, "fact_without_measures") else tables
    facts = (
        row_counts(counted, _FACTS)
        .agg(
            F.bool_and(F.col("row_count") > 0).alias("passed"),
            F.map_from_entries(
                F.array_sort(F.collect_list(F.struct("table", F.col("row_count").cast("string"))))
            ).alias("metadata"),
        )
        .select(
            F.lit("mart_row_counts").alias("check"), F.lit("WARN").alias("severity"),
            "passed", "metadata",
        )
    )
    xref = tables.get("int_player_xref")
    # A warehouse has the ids of players in its shared columns and need not write the whole relation.
    staged = tables.staged()[0] if hasattr(tables, "staged") else tables.get("stg_fbref__player_season_stats")
    if xref is None or staged is None:
        spark = SparkSession.getActiveSession()
        rate = spark.createDataFrame(
            [("player_xref_match_rate", "WARN", False, {"detail": "relations are not built"})],
            "check string, severity string, passed boolean, metadata map<string,string>",
        )
    else:
        rate = match_rate(xref, staged).select(
            F.lit("player_xref_match_rate").alias("check"),
            F.lit("WARN").alias("severity"),
            "passed",
            F.when(F.col("total") == 0, F.create_map(F.lit("detail"), F.lit("no players")))
            .otherwise(
                F.create_map(
                    F.lit("matched"), F.col("matched").cast("string"),
                    F.lit("total"), F.col("total").cast("string"),
                    F.lit("match_rate"), F.col("match_rate").cast("string"),
                )
            )
            .alias("metadata"),
        )
    return raw.unionByName(rate).unionByName(facts)


def enforce(results: DataFrame) -> list:
    """Raise on a failed check of severity ERROR; returns the (handful of) result rows."""
    rows = results.collect()
    failed = [r["check"] for r in rows if r["severity"] == "ERROR" and not r["passed"]]
    if failed:
        raise CheckFailed(", ".join(failed))
    return rows
