"""Which pages of a corpus are missing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.sources.pages import total_pages
from touchline.sources.seeds import LEAGUES, SEASON_LABELS

# How each source names the leagues in its page addresses.
SOURCE_LEAGUE_KEYS = {
    "fbref": {
        "Premier League": "9/Premier-League",
        "La Liga": "12/La-Liga",
        "Bundesliga": "20/Bundesliga",
        "Serie A": "11/Serie-A",
        "Ligue 1": "13/Ligue-1",
    },
    "understat": {
        "Premier League": "EPL",
        "La Liga": "La_Liga",
        "Bundesliga": "Bundesliga",
        "Serie A": "Serie_A",
        "Ligue 1": "Ligue_1",
    },
    "transfermarkt": {
        "Premier League": "GB1/premier-league",
        "La Liga": "ES1/la-liga",
        "Bundesliga": "L1/1-bundesliga",
        "Serie A": "IT1/serie-a",
        "Ligue 1": "FR1/ligue-1",
    },
}


_PAGES_PER_BLOCK = 10_000


def expected_grid(spark: SparkSession, seasons: list[str] = SEASON_LABELS) -> DataFrame:
    """source, league, league key and season that a complete corpus has pages for."""
    rows = [
        (source, league, key, season)
        for source, keys in SOURCE_LEAGUE_KEYS.items()
        for league, key in ((name, keys[name]) for name in LEAGUES)
        for season in seasons
    ]
    return spark.createDataFrame(
        rows, "source string, league string, league_key string, season string"
    )


def missing_ranges(pages: DataFrame, grid: DataFrame) -> DataFrame:
    """The grid with ranges of missing page numbers (first_page, last_page), up to the number that a listing
    announces (1 if there is no page yet). Page numbers that are present are only compared with their
    neighbours, so a listing that announces a huge number is one row.
    """
    keys = ["source", "league", "season"]
    announced = (
        pages.select(*keys, total_pages(F.col("body")).alias("n")).groupBy(*keys).agg(F.max("n").alias("n"))
    )
    wanted = grid.join(announced, keys, "left").withColumn("n", F.coalesce("n", F.lit(1)))
    present = pages.select(*keys, "page_no").distinct().filter("page_no >= 1")
    # Each listing ends in a mark behind its last page.
    marks = wanted.select(*keys, (F.col("n") + 1).cast("int").alias("page_no"), F.lit(True).alias("mark"))
    inside = present.join(wanted.select(*keys, "n"), keys).filter("page_no <= n")
    points = inside.select(*keys, "page_no", F.lit(False).alias("mark")).union(marks)
    before = F.lag("page_no", 1, 0).over(Window.partitionBy(*keys).orderBy("page_no"))
    gaps = points.withColumn("before", before).filter("page_no - before > 1")
    return wanted.drop("n").join(
        gaps.select(*keys, (F.col("before") + 1).alias("first_page"), (F.col("page_no") - 1).alias("last_page")), keys
    )


def missing_pages(pages: DataFrame, grid: DataFrame) -> DataFrame:
    """The grid with one row per missing page number. Long ranges are cut into blocks that are dealt out first."""
    block = F.expr(f"explode(sequence(0, (last_page - first_page) div {_PAGES_PER_BLOCK}))").alias("block")
    blocks = missing_ranges(pages, grid).select("*", block).repartition("source", "league", "season", "block")
    first = F.col("first_page") + F.col("block") * _PAGES_PER_BLOCK
    last = F.least("last_page", first + (_PAGES_PER_BLOCK - 1))
    return blocks.select(*grid.columns, F.explode(F.sequence(first.cast("int"), last.cast("int"))).alias("page_no"))
