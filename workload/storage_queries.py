"""Replacing one partition of a raw table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.schemas import record_schema
from touchline.session import shared_folder, written
from touchline.sources.raw_table import (
    drop_raw_table, qualified_name, read_raw_table, rejected_name, replace_season, replace_seasons,
)
from touchline.sources.records import split_records
from touchline.sources.seeds import team_aliases
from workload.league import read
from workload.registry import query

_EVENTS = record_schema("event_id bigint, user_id bigint, event_type string, value double")
_DAY = "2024-01-03"


def _batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value",
        F.lit("2025-01-01").cast("timestamp").alias("_ingested_at"),
        F.lit("events").alias("_source_url"),
        F.date_format("ts", "yyyy-MM-dd").alias("_season"),
    )


def summary_of(spark: SparkSession, table: str, summary: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A small result out of a table, written so that the table can be dropped."""
    rows = written(summary(spark.table(qualified_name(table))), shared_folder(spark), "rows")
    drop_raw_table(spark, table)
    return rows


def _days(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.col("_season").alias("day")).agg(
        F.count(F.lit(1)).alias("n_events"), F.countDistinct("user_id").alias("n_users"),
        F.max("event_id").alias("last_event"), F.max("value").alias("top_value"),
    )


def _replaced(spark: SparkSession, sf_dir: str, change) -> DataFrame:
    """Load all days, replace one day twice by the changed batch, read the table back."""
    table, location = f"events_{uuid.uuid4().hex}", shared_folder(spark)
    batch = _batch(spark, sf_dir)
    replace_seasons(spark, table, batch, _EVENTS, location)
    for _ in range(2):
        replace_season(spark, table, change(batch), _EVENTS, _DAY, location)
    return summary_of(spark, table, _days)


_TABLE_SQL = """SELECT day, count(*) AS n_events, count(DISTINCT user_id) AS n_users,
  max(event_id) AS last_event, max(value) AS top_value
FROM (SELECT *, strftime(ts, '%Y-%m-%d') AS day FROM events)"""


@query(
    _TABLE_SQL.replace("SELECT *,", "SELECT event_id, user_id, event_type, ts, CASE WHEN "
                       f"strftime(ts, '%Y-%m-%d') = '{_DAY}' THEN value + 1000 ELSE value END AS value,")
    + f" WHERE day <> '{_DAY}' OR event_type <> 'error' GROUP BY day"
)
def replace_partition(spark, sf_dir):
    def change(batch: DataFrame) -> DataFrame:
        return batch.filter(F.col("event_type") != "error").withColumn("value", F.col("value") + 1000)

    return _replaced(spark, sf_dir, change)


@query(_TABLE_SQL + f" WHERE day <> '{_DAY}' GROUP BY day")
def replace_partition_empty(spark, sf_dir):
    return _replaced(spark, sf_dir, lambda batch: batch.filter(F.lit(False)))


_LINES = record_schema("l_orderkey bigint, l_linenumber int, l_quantity double", "l_orderkey l_linenumber l_quantity")

_LINES_SQL = """SELECT l_orderkey, year(l_shipdate)::VARCHAR AS season, l_quantity,
  CASE WHEN l_quantity > 45 AND l_tax = 0 THEN 'missing l_linenumber, l_quantity' WHEN l_quantity > 45 THEN 'missing l_quantity'
    WHEN l_tax = 0 THEN 'missing l_linenumber' END AS reason
FROM lineitem"""


@query(
    f"""SELECT season, coalesce(reason, 'valid') AS reason, count(*) AS n_rows, sum(l_orderkey) AS orders FROM (
  SELECT * FROM ({_LINES_SQL}) WHERE season <> '1995'
  UNION ALL SELECT * FROM ({_LINES_SQL}) WHERE season = '1995' AND l_orderkey % 2 = 0) GROUP BY ALL"""
)
def rejected_records(spark, sf_dir):
    """Records and rejects of all seasons in one batch, then of one season in another, both tables read together."""
    table, location = f"lines_{uuid.uuid4().hex}", shared_folder(spark)
    lines = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.when(F.col("l_tax") > 0, F.col("l_linenumber")).alias("l_linenumber"),
        F.when(F.col("l_quantity") <= 45, F.col("l_quantity")).alias("l_quantity"),
        F.lit("2025-01-01").cast("timestamp").alias("_ingested_at"), F.lit("lines").alias("_source_url"),
        F.year("l_shipdate").cast("string").alias("_season"),
    )

    def halves(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        valid, rejected = split_records(rows, _LINES)
        return valid, rejected.withColumn("_what", F.lit("record")).withColumn("_detail", F.to_json(F.struct(*rows.columns)))

    valid, rejected = halves(lines)
    replace_seasons(spark, table, valid, _LINES, location, rejected)
    valid, rejected = halves(lines.filter(F.col("l_orderkey") % 2 == 0))
    replace_season(spark, table, valid, _LINES, "1995", location, rejected)

    def counts(rows: DataFrame, reason) -> DataFrame:
        return rows.groupBy(F.col("_season").alias("season"), reason.alias("reason")).agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum("l_orderkey").alias("orders"))

    refused = spark.table(rejected_name(table))
    return summary_of(spark, table, lambda kept: counts(kept, F.lit("valid")).union(counts(refused, F.col("reject_reason"))))


@query("SELECT count(*) FILTER (FALSE) AS n_rows, count(DISTINCT l_returnflag) AS n_flags FROM lineitem")
def missing_table(spark, sf_dir):
    """A raw table that was never written is an empty relation that joins like any other."""
    empty = read_raw_table(spark, f"never_{uuid.uuid4().hex}", _EVENTS)
    lines = read(spark, sf_dir, "lineitem")
    found = lines.join(empty, F.col("l_orderkey") == F.col("event_id"), "left")
    return found.agg(
        F.count("event_id").alias("n_rows"), F.countDistinct("l_returnflag").alias("n_flags")
    )


@query(
    """SELECT CASE WHEN s_suppkey % 3 = 0 THEN '#' ELSE '' END || s_name AS source_team_name,
  s_nationkey::VARCHAR AS canonical_team_name, nullif(s_suppkey % 4, 0)::VARCHAR AS league FROM supplier"""
)
def seed_file(spark, sf_dir):
    """A seed at rest: rows may begin with any character, blank cells are NULL."""
    path = f"{shared_folder(spark)}/seed"
    name = F.concat(F.when(F.col("s_suppkey") % 3 == 0, "#").otherwise(""), "s_name")
    read(spark, sf_dir, "supplier").select(
        name.alias("source"), name.alias("source_team_name"),
        F.col("s_nationkey").cast("string").alias("canonical_team_name"),
        F.nullif(F.col("s_suppkey") % 4, F.lit(0)).cast("string").alias("league"),
    ).write.option("header", True).csv(path)
    return team_aliases(spark, path).select("source_team_name", "canonical_team_name", "league")
