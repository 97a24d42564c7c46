"""Raw tables: one Parquet table per source, replaced season by season."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.schemas import record_schema, with_metadata
from touchline.sources.batches import KIND, VALID, BatchTable
from touchline.sources.seeds import LEAGUES

SEASON = "_season"
REJECTED = "rejected"
# What was rejected (a record, a row of a page, a page), why, and the source row as JSON.
REJECT_COLUMNS = record_schema("_what string, reject_reason string, _detail string")


def database_of(table: str) -> str:
    """``raw_x__y`` lives in database ``raw_x``, a name without '__' in the default one."""
    head, separator, _ = table.partition("__")
    return head if separator else "default"


def qualified_name(table: str) -> str:
    return f"{database_of(table)}.{table}"


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(qualified_name(table))


def read_raw_table(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """The table, or an empty relation of its schema if it was never written."""
    if table_exists(spark, table):
        return spark.table(qualified_name(table))
    return spark.createDataFrame([], with_metadata(schema))


def rejected_name(table: str) -> str:
    """Qualified name of the records, rows and pages of a raw table that gave no valid record."""
    return f"{qualified_name(table)}__rejected"


def _batches(spark: SparkSession, table: str) -> BatchTable:
    return BatchTable(spark, qualified_name(table), SEASON)


def create_raw_table(
    spark: SparkSession, table: str, schema: T.StructType, location: str | None = None
) -> BatchTable:
    """Create database and table if missing, with the table of what is rejected beside it.

    NOT NULL is kept by ``records.split_records``.
    """
    names = schema.names
    columns = T.StructType([f for f in schema.fields if f.name != SEASON] + REJECT_COLUMNS.fields)
    views = {VALID: (qualified_name(table), names), REJECTED: (rejected_name(table), [*REJECT_COLUMNS.names, *names])}
    batches = _batches(spark, table)
    batches.create(columns, views, location)
    return batches


def drop_raw_table(spark: SparkSession, table: str) -> None:
    """Remove a raw table; files stay where a location was given."""
    _batches(spark, table).drop([qualified_name(table), rejected_name(table)])


def source_url_list(pages: DataFrame, leagues: list[str] = LEAGUES) -> str:
    """Address of the first page of each league, in league order, joined by '; '.

    One text stands for the whole batch of a season, so the pages are reduced to one column per
    league with partial aggregates; only that one row comes to the driver.
    """
    first_page = F.when(F.col("page_no") == 1, F.col("url"))
    per_league = [F.min(F.when(F.col("league") == name, first_page)) for name in leagues]
    return pages.agg(F.concat_ws("; ", *per_league).alias("urls")).first()["urls"]


def stamp(df: DataFrame, season: str, source_url: str, at: datetime | None = None) -> DataFrame:
    """Add ingest time (one instant per batch), source addresses and season."""
    instant = (at or datetime.now(tz=UTC)).astimezone(UTC)
    return (
        df.withColumn("_ingested_at", F.lit(instant.isoformat()).cast("timestamp"))
        .withColumn("_source_url", F.lit(source_url))
        .withColumn(SEASON, F.lit(season))
    )


def _stored(batch: DataFrame, rejected: DataFrame | None, schema: T.StructType) -> DataFrame:
    """Valid and rejected rows with the columns of the base table."""
    nothing = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in REJECT_COLUMNS.fields}
    rows = batch.select(*schema.names, *nothing.values(), F.lit(VALID).alias(KIND))
    if rejected is None:
        return rows
    return rows.union(rejected.select(*schema.names, *REJECT_COLUMNS.names, F.lit(REJECTED).alias(KIND)))


def replace_season(
    spark: SparkSession,
    table: str,
    batch: DataFrame,
    schema: T.StructType,
    season: str,
    location: str | None = None,
    rejected: DataFrame | None = None,
) -> int:
    """Replace one season of a raw table by a stamped batch; returns the rows written.

    The batch is written to new files and the table is then switched to them, so a batch that fails leaves the old
    rows. A rerun gives the same table, other seasons are not touched, and an empty batch clears the
    season. ``rejected`` (stamped too, with the columns of ``REJECT_COLUMNS``) is kept in a table of its own, which is
    switched in the same moment.
    """
    schema = with_metadata(schema)
    rows = _stored(batch, rejected, schema).filter(F.col(SEASON) == season)
    return create_raw_table(spark, table, schema, location).replace(rows, [season])


def replace_seasons(
    spark: SparkSession,
    table: str,
    batch: DataFrame,
    schema: T.StructType,
    location: str | None = None,
    rejected: DataFrame | None = None,
) -> int:
    """Replace every season that a stamped batch holds, all of them in one moment; for backfills.

    Rows are rebalanced by season, so that a season becomes few files and a large one is split
    over several tasks.
    """
    schema = with_metadata(schema)
    rows = _stored(batch, rejected, schema).hint("rebalance", SEASON)
    return create_raw_table(spark, table, schema, location).replace(rows)
