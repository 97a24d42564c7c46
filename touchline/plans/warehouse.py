"""From pages to raw tables, and from raw tables to the star schema."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from touchline.functions.keys import surrogate_key
from touchline.plans import dimensions, facts, players, staging, teams
from touchline.schemas import RAW_TABLES
from touchline.session import CODEC, FILE_ROWS, free_shuffles, remove_folder, shared_folder, small_scans, written
from touchline.sources import pages as page_readers
from touchline.sources.batches import KIND, VALID, BatchTable
from touchline.sources.raw_table import (
    SEASON, read_raw_table, rejected_name, replace_season, source_url_list, stamp,
)
from touchline.sources.records import split_records
from touchline.sources.seeds import LEAGUES, SEASON_LABELS

# Raw table, rows of pages, and the typed records of these rows.
_READERS = {
    "fbref": (
        "raw_fbref__player_season_stats", page_readers.fbref_rows, page_readers.fbref_records,
    ),
    "understat": (
        "raw_understat__player_season_stats", page_readers.understat_rows,
        page_readers.understat_records,
    ),
    "understat_json": (
        "raw_understat__player_season_stats", page_readers.understat_json_rows,
        page_readers.understat_records,
    ),
    "transfermarkt": (
        "raw_transfermarkt__player_valuations", page_readers.transfermarkt_rows,
        page_readers.transfermarkt_records,
    ),
}


class IngestResult(NamedTuple):
    """What a season gave. The relations read the table of rejects, which keeps them until the season is replaced."""

    row_count: int
    leagues: list[str]
    season: str
    rejected: DataFrame
    # Pages that gave no rows, with the reason, and rows that are no records.
    page_problems: DataFrame
    skipped_rows: DataFrame


def ingest_season(
    pages: DataFrame,
    source: str,
    season: str,
    at: datetime | None = None,
    location: str | None = None,
    table: str | None = None,
    allow_unreadable: bool = False,
) -> IngestResult:
    """Read one season of one source's pages into its raw table (``table``, if another name is given).

    ``source`` is a key of the readers; pages of the JSON form carry the source name without the
    suffix. The rows of pages are written once before they are split, so pages are parsed a single
    time for the valid records, the rejected ones and the problems. Pages of which none could be
    read do not clear the season, unless ``allow_unreadable`` asks for it.
    """
    if season not in SEASON_LABELS:
        raise ValueError(f"season {season!r} is not one of {', '.join(SEASON_LABELS)}")
    spark = pages.sparkSession
    default_table, read_rows, to_records = _READERS[source]
    schema = RAW_TABLES[default_table]
    batch = pages.filter(
        (F.col("source") == source.removesuffix("_json")) & (F.col("season") == season)
    )
    folder = shared_folder(spark)
    try:
        rows = written(read_rows(batch), folder, f"{source}_rows")
        problems = page_readers.page_problems(rows)
        if not allow_unreadable and not problems.isEmpty() and rows.filter("page_problem is null").isEmpty():
            reasons = [r["reason"] for r in problems.select("reason").distinct().limit(5).collect()]
            raise ValueError(f"no page of {source} {season} could be read: {', '.join(sorted(reasons))}")
        valid, rejected = split_records(to_records(rows), schema)
        skipped = rows.filter("page_problem is null and skip_reason is not null")
        aside = _aside("record", rejected, F.col("reject_reason"), schema)
        aside = aside.union(_aside("row", skipped, F.col("skip_reason"), schema))
        aside = aside.union(_aside("page", problems, F.col("reason"), schema))
        urls, at = source_url_list(batch), at or datetime.now(tz=UTC)
        name = table or default_table
        count = replace_season(
            spark, name, stamp(valid, season, urls, at), schema, season, location, stamp(aside, season, urls, at))
    finally:
        remove_folder(spark, folder)
    kept = spark.table(rejected_name(name)).filter(F.col(SEASON) == season)
    parts = {what: kept.filter(F.col("_what") == what) for what in ("record", "page", "row")}
    return IngestResult(count, LEAGUES, season, parts["record"], parts["page"], parts["row"])


def _aside(what: str, rows: DataFrame, reason: Column, schema: StructType) -> DataFrame:
    """Rows for the table of rejects: the columns that they share with records, the reason, and all else as JSON."""
    columns = [
        (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    detail = F.to_json(F.struct(*rows.columns))
    return rows.select(*columns, F.lit(what).alias("_what"), reason.alias("reject_reason"), detail.alias("_detail"))


def raw_tables(spark: SparkSession) -> dict[str, DataFrame]:
    return {name: read_raw_table(spark, name, schema) for name, schema in RAW_TABLES.items()}


class Warehouse(Mapping):
    """All relations by name, each planned when it is first asked for.

    A relation that more than one other relation reads (staging, cross-references, dimensions) is
    written once to the shared folder and read back, so a fact does not repeat the matching for
    each of its inputs. Of staging only the columns that the others read are written, until it is asked for by name. ``clean`` and ``one_to_one`` leave the original semantics where these
    multiply rows; see ``facts`` and ``players.each_id_once``. ``assign`` gives each id to one player of a season as an
    assignment, ``team_ladder`` brings clubs together by affix-free names too. ``reads`` names the readers (keys of
    ``_READ_BY``) that staging is written for from the start; another one has its columns written when it comes.
    Facts stay lazy for the caller.
    """

    def __init__(
        self,
        raw: Mapping[str, DataFrame],
        aliases: DataFrame,
        overrides: DataFrame,
        folder: str | None = None,
        strict_parity: bool = False,
        clean: bool = False,
        one_to_one: bool = False,
        team_ladder: bool = False,
        assign: bool = False,
        reads: Sequence[str] = ("dimensions", "fct_player_season_valuations"),
    ):
        self.spark = aliases.sparkSession
        self.folder = folder or shared_folder(self.spark)
        self.aliases, self.overrides, self.strict_parity = aliases, overrides, strict_parity
        self.clean, self.one_to_one = clean, one_to_one
        self.team_ladder, self.assign, self.reads = team_ladder, assign, tuple(reads)
        self._ready: dict[str, DataFrame] = dict(raw)
        self._narrow: dict[str, DataFrame] = {}
        small_scans(self.spark)
        free_shuffles(self.spark)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._ready:
            if name in _STAGING:
                self._ready[name] = self.keep(_STAGING[name](self), name)
            elif name in _RELATIONS:
                self._ready[name] = _RELATIONS[name](self)
            else:
                raise KeyError(name)
        return self._ready[name]

    def __iter__(self):
        return iter([*RAW_TABLES, *_STAGING, *_RELATIONS])

    def __len__(self) -> int:
        return len(RAW_TABLES) + len(_STAGING) + len(_RELATIONS)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        return written(df, self.folder, name, FILE_ROWS, CODEC)

    def staged(self, *readers: str, only: Sequence[str] = ()) -> tuple[DataFrame | None, ...]:
        """What cross-references read of the staging relations, and what the named readers and those of ``reads`` read
        beside it: whole relations where these are written already, else these columns. They depend on raw tables only;
        their jobs run side by side. ``only`` names the relations that are needed; others may be None."""
        planned, readers = {}, tuple(dict.fromkeys(["matching", *self.reads, *readers]))
        for name in only or _STAGING:
            columns = [c for reader in readers for c in _READ_BY[reader].get(name, [])]
            there = self._there(name)
            if there is None or not set(columns) <= set(there.columns):
                # What an earlier reader had stays in, so that it need not be written a third time.
                earlier = [] if there is None else there.columns
                planned[name] = list(dict.fromkeys([*earlier, *columns]))
        with ThreadPoolExecutor(max(1, len(planned))) as jobs:
            names = [f"{name}__{'_'.join(['for', *readers])}" for name in planned]
            self._narrow.update(zip(planned, jobs.map(self._narrowed, planned, planned.values(), names)))
        return tuple(self._there(name) for name in _STAGING)

    def _narrowed(self, name: str, columns: Sequence[str], at: str) -> DataFrame:
        """Some columns of a staging relation, written. Its surrogate key is not: it is worked out again from the columns
        that it is made of, which take a fraction of its bytes."""
        key, parts = staging.KEYS[name]
        stored = [c for c in columns if c != key] + (parts if key in columns else [])
        kept = self.keep(_STAGING[name](self).select(*dict.fromkeys(stored)), at)
        return kept.withColumn(key, surrogate_key(*parts)) if key in columns else kept

    def _there(self, name: str) -> DataFrame | None:
        return self._ready.get(name, self._narrow.get(name))

    def clubs(self) -> tuple[DataFrame, ...]:
        """What the cross-reference of teams reads: written staging relations, else clubs alone, straight from raw rows."""
        return tuple(
            plan(self) if self._there(name) is None else self._there(name) for name, plan in _CLUBS.items())

    def fact(self, name: str, seasons: list[str] | None = None) -> DataFrame:
        """A fact, of some seasons only if these are named: their rows are chosen before anything is joined."""
        staged = self.staged("dimensions", name)
        if seasons is not None:
            staged = [df.filter(F.col("season").isin(seasons)) for df in staged]
        return _FACTS[name](self, *staged)

    def fact_without_measures(self, name: str) -> DataFrame:
        """The rows of a fact, for counts and tests of some columns: measures that no reader had written are NULL."""
        staged = []
        for source, df in zip(_STAGING, self.staged("dimensions")):
            absent = [c for c in _READ_BY[name].get(source, []) if c not in df.columns]
            staged.append(df.withColumns({c: F.lit(None).cast("string") for c in absent}))
        return _FACTS[name](self, *staged)

    def resolved(self) -> DataFrame:
        """The cross-reference of players, written. What only its steps read is removed after that."""
        staged, clubs, steps = self.staged(), self["int_team_xref"], "matching"
        found = players.resolve_players(
            *staged, clubs, self.overrides, lambda df, name: self.keep(df, f"{steps}/{name}"),
            one_to_one=self.one_to_one, assign=self.assign)
        found = self.keep(found, "int_player_xref")
        remove_folder(self.spark, f"{self.folder}/{steps}")
        return found

    def close(self) -> None:
        """Remove what the warehouse wrote; its relations cannot be read after that."""
        remove_folder(self.spark, self.folder)

    def __enter__(self) -> Warehouse:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def dimensions(self) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
        return tuple(self[d] for d in ("dim_player", "dim_team", "dim_season", "dim_competition"))


_STAGING: dict[str, Callable[[Warehouse], DataFrame]] = {
    "stg_fbref__player_season_stats": lambda w: staging.stage_fbref(
        w["raw_fbref__player_season_stats"]
    ),
    "stg_understat__player_season_stats": lambda w: staging.stage_understat(
        w["raw_understat__player_season_stats"]
    ),
    "stg_transfermarkt__player_valuations": lambda w: staging.stage_transfermarkt(
        w["raw_transfermarkt__player_valuations"], w.strict_parity
    ),
}

_FBREF = ["stg_fbref__player_season_stats"]

_CLUBS: dict[str, Callable[[Warehouse], DataFrame]] = {
    "stg_fbref__player_season_stats": lambda w: staging.fbref_clubs(w["raw_fbref__player_season_stats"]),
    "stg_understat__player_season_stats": lambda w: staging.understat_clubs(w["raw_understat__player_season_stats"]),
    "stg_transfermarkt__player_valuations": lambda w: staging.transfermarkt_clubs(
        w["raw_transfermarkt__player_valuations"]
    ),
}

# What cross-references read of staging, and what dimensions and facts read beside it.
_READ_BY = {
    "matching": {
        "stg_fbref__player_season_stats": [
            "fbref_player_id", "fbref_team_id", "league", "season", "player_name", "team_name", "position", "minutes",
        ],
        "stg_understat__player_season_stats": [
            "understat_player_id", "season", "player_name", "team_name", "league", "position_group", "minutes",
        ],
        "stg_transfermarkt__player_valuations": [
            "transfermarkt_player_id", "transfermarkt_team_id", "season", "player_name", "team_name", "league",
            "position", "market_value_eur",
        ],
    },
    "dimensions": {
        "stg_fbref__player_season_stats": ["player_name_raw", "team_name_raw", "nationality", "age_years"],
    },
    "fct_player_season_stats": {
        "stg_fbref__player_season_stats": [
            *(c for c in facts.FBREF_MEASURES if c != "minutes"), *facts.FBREF_EXPECTED, *facts.FBREF_RATES],
        "stg_understat__player_season_stats": [
            "xg", "xg_assist", "npxg", "xg_chain", "xg_buildup", "shots", "key_passes"],
    },
    "fct_player_season_valuations": {
        "stg_transfermarkt__player_valuations": ["nationality", "date_of_birth"],
    },
    # What the data tests look at, in staging and through the facts.
    "data_tests": {
        "stg_fbref__player_season_stats": ["player_season_team_id", "goals", "assists", "xg"],
        "stg_understat__player_season_stats": [
            "player_season_team_id", "goals", "xg", "xg_assist", "xg_chain", "xg_buildup", "shots"],
        "stg_transfermarkt__player_valuations": ["player_valuation_id"],
    },
}

_RELATIONS: dict[str, Callable[[Warehouse], DataFrame]] = {
    "int_team_xref": lambda w: w.keep(
        teams.team_xref(*w.clubs(), w.aliases, ladder=w.team_ladder), "int_team_xref"
    ),
    "int_player_xref": lambda w: w.resolved(),
    "dim_season": lambda w: dimensions.dim_season(w.spark),
    "dim_competition": lambda w: dimensions.dim_competition(w.spark),
    # Written dimensions have a known size: the facts broadcast a small one without first
    # shuffling their own rows for it.
    "dim_team": lambda w: w.keep(
        dimensions.dim_team(w.staged("dimensions", only=_FBREF)[0], w["int_team_xref"]), "dim_team"
    ),
    "dim_player": lambda w: w.keep(
        dimensions.dim_player(w.staged("dimensions")[0], w["int_player_xref"]), "dim_player"
    ),
    "fct_player_season_stats": lambda w: w.fact("fct_player_season_stats"),
    "fct_player_season_valuations": lambda w: w.fact("fct_player_season_valuations"),
}

# Facts are computed and replaced season by season; the other relations need all seasons.
_FACTS: dict[str, Callable[..., DataFrame]] = {
    "fct_player_season_stats": lambda w, fbref, understat, _: facts.fct_player_season_stats(
        fbref, understat, w["int_player_xref"], w["int_team_xref"], *w.dimensions(), clean=w.clean,
    ),
    "fct_player_season_valuations": lambda w, _fbref, _understat, valuations: facts.fct_player_season_valuations(
        valuations, w["int_player_xref"], w["int_team_xref"], *w.dimensions()
    ),
}


_WHOLE = "all"


def _save(spark: SparkSession, name: str, df: DataFrame, part: str, clear: list[str]) -> None:
    table = BatchTable(spark, name, part)
    columns = [f for f in df.schema.fields if f.name != part]
    shown = [c for c in df.columns if c != "_part"]
    table.create(StructType([StructField(f.name, f.dataType) for f in columns]), {VALID: (name, shown)})
    table.replace(df.withColumn(KIND, F.lit(VALID)), clear)


def save_marts(warehouse: Warehouse, database: str, seasons: list[str] | None = None) -> None:
    """Write dimensions, facts and cross-references as tables of a database.

    Each relation is written beside the old one, and readers are switched to it in one operation: a build that fails
    leaves every table as it was, or some of them whole and new. Facts are written by season. With ``seasons`` only these
    are computed and written again, the partitions of the others stay as they are; a season without rows is cleared.
    """
    spark = warehouse.spark
    warehouse.staged("dimensions", *_FACTS)
    labels = [(r.season_label, r.season_key) for r in warehouse["dim_season"].collect()]  # three rows
    keys = [key for label, key in labels if seasons is None or label in seasons]
    for name in _RELATIONS:
        if name not in _FACTS:
            _save(spark, f"{database}.{name}", warehouse[name].withColumn("_part", F.lit(_WHOLE)), "_part", [_WHOLE])
    for name in _FACTS:
        _save(spark, f"{database}.{name}", warehouse.fact(name, seasons), "season_key", keys)
