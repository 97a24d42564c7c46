"""Corpora of saved pages to raw records.

A page is one row (source, league, season, page_no, url, body). Python only turns table markup
into rows of text; ids, numbers, dates and money are typed by Catalyst expressions afterwards,
and the Understat pages need no Python at all.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions import text
from touchline.schemas import FBREF_STATS, TRANSFERMARKT_VALUATIONS, UNDERSTAT_STATS
from touchline.sources import markup

_ROWS_PER_PIECE = 5_000
_PAGE_KEYS = ["league", "season", "page_no", "url"]

# Id of the statistics table and the cells that are typed.
_STATS_TABLE = "stats_standard"
_TEXT_CELLS = ["nationality", "position", "age"]
_INT_CELLS = [
    "games", "games_starts", "minutes", "goals", "assists", "goals_pens", "pens_made", "pens_att",
    "cards_yellow", "cards_red",
]
_DOUBLE_CELLS = [
    "xg", "npxg", "xg_assist", "goals_per90", "assists_per90", "goals_assists_per90",
    "goals_pens_per90", "goals_assists_pens_per90", "xg_per90", "xg_assist_per90",
    "xg_xg_assist_per90", "npxg_per90", "npxg_xg_assist_per90",
]
_CELLS = ["player", "team", *_TEXT_CELLS, *_INT_CELLS, *_DOUBLE_CELLS]

# Keys of the embedded player objects and the columns they become.
_UNDERSTAT_FIELDS = {
    "player_id": "id",
    "player_name": "player_name",
    "team_name": "team_title",
    "position": "position",
    "games": "games",
    "minutes": "time",
    "goals": "goals",
    "assists": "assists",
    "npg": "npg",
    "xg": "xG",
    "xg_assist": "xA",
    "npxg": "npxG",
    "xg_chain": "xGChain",
    "xg_buildup": "xGBuildup",
    "shots": "shots",
    "key_passes": "key_passes",
    "yellow_cards": "yellow_cards",
    "red_cards": "red_cards",
}

# Markup of the page list of a paged listing.
_CLASS = r"""\bclass\s*=\s*(?:"(?:[^"]*\s)?{0}(?:\s[^"]*)?"|'(?:[^']*\s)?{0}(?:\s[^']*)?'|{0}(?=[\s>]))"""
_PAGER = rf"(?is)<ul\b[^>]*{_CLASS.format('tm-pagination')}[^>]*>(.*?)</ul>"
_PAGER_LINK = rf"(?is)<a\b[^>]*{_CLASS.format('tm-pagination__link')}[^>]*>(.*?)</a>"


def _strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _rows_of_pages(pages: DataFrame, read_page, names: list[str]) -> DataFrame:
    """Apply ``read_page(body) -> iterable of tuples of text`` to every page of the corpus."""
    keep = [f for f in pages.schema.fields if f.name in _PAGE_KEYS]
    keys = [f.name for f in keep]
    schema = T.StructType(keep + _strings(names).fields)

    def piece(batch: pa.RecordBatch, places: list[int], found: list[tuple]) -> pa.RecordBatch:
        of_page = [batch.column(k).take(pa.array(places)) for k in keys]
        return pa.RecordBatch.from_arrays([*of_page, *[pa.array(c, pa.string()) for c in zip(*found)]], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places: list[int] = []
            found: list[tuple] = []
            for place, body in enumerate(batch.column("body")):
                found.extend(read_page(body.as_py() or ""))
                places.extend([place] * (len(found) - len(places)))
                # Rows leave in pieces, so that a batch of large pages is never held whole.
                if len(found) >= _ROWS_PER_PIECE:
                    yield piece(batch, places, found)
                    places, found = [], []
            if found:
                yield piece(batch, places, found)

    return pages.select(*keys, "body").mapInArrow(run, schema)


def _link(cell: markup.Node | None) -> str | None:
    if cell is None:
        return None
    return next((n.attrs["href"] for n in cell.find_all("a") if "href" in n.attrs), None)


def _no_rows(table: markup.Node | None, names: list[str]) -> tuple:
    """The row of a page that has none: it says what was not found."""
    return ("table not found" if table is None else "body not found", *[None] * (len(names) - 1))


def page_problems(rows: DataFrame) -> DataFrame:
    """Pages that gave no rows, with the reason, out of the rows of any reader."""
    found = rows.filter(F.col("page_problem").isNotNull())
    return found.select(*[c for c in _PAGE_KEYS if c in rows.columns], F.col("page_problem").alias("reason"))


# --- statistics tables ---------------------------------------------------------------------


def _stats_table(html: str) -> markup.Node | None:
    root, comments = markup.parse(html)
    table = root.find("table", id=_STATS_TABLE)
    if table is not None:
        return table
    for comment in comments:
        if _STATS_TABLE in comment:
            table = markup.parse(comment)[0].find("table", id=_STATS_TABLE)
            if table is not None:
                return table
    return None


_STATS_ROW = ["page_problem", "row_class", "ranker", "player_href", "team_href", "nationality_td", *_CELLS]


def _places(starts: tuple[str, ...]) -> tuple[int | None, ...]:
    """Where a row has the rank, the nationality of a data cell, and each of ``_CELLS``."""
    first: dict[str, int] = {}
    ranker = nationality = None
    for place, start in enumerate(starts):
        stat = markup.attributes(start[2:]).get("data-stat", "")
        first.setdefault(stat, place)
        if stat == "ranker" and start.startswith("th") and ranker is None:
            ranker = place
        if stat == "nationality" and start.startswith("td") and nationality is None:
            nationality = place
    return ranker, nationality, *[first.get(c) for c in _CELLS]


def _read_plain_row(row: markup.PlainRow, layouts: dict[tuple[str, ...], tuple[int | None, ...]]) -> tuple:
    """What ``_read_stats_page`` takes from a row, straight from the markup of its cells.

    ``layouts`` remembers the places of cells: the rows of a table have the same start tags, or few kinds of them.
    """
    starts, contents = tuple(row.starts), row.contents
    places = layouts.get(starts)
    if places is None:
        places = layouts[starts] = _places(starts)
    texts: list[str | None] = [markup.plain_text(content) if content else "" for content in contents]
    texts.append(None)
    player, team = [markup.plain_link(contents[p]) if p is not None else None for p in places[2:4]]
    ranker, *values = [texts[-1 if p is None else p] for p in places]
    return None, " ".join(row.classes), ranker, player, team, *values


def _read_stats_page(html: str):
    table = _stats_table(html)
    body = table.find("tbody") if table is not None else None
    if body is None:
        yield _no_rows(table, _STATS_ROW)
        return
    layouts: dict[tuple[str, ...], tuple[int | None, ...]] = {}
    for row in body.all_rows():
        if isinstance(row, markup.PlainRow):
            yield _read_plain_row(row, layouts)
            continue
        cells: dict[str, markup.Node] = {}
        ranker = nationality = None
        for cell in row.find_all("td", "th"):
            stat = cell.attrs.get("data-stat", "")
            cells.setdefault(stat, cell)
            if stat == "ranker" and cell.tag == "th" and ranker is None:
                ranker = cell.text
            if stat == "nationality" and cell.tag == "td" and nationality is None:
                nationality = cell.text
        yield (
            None, " ".join(row.classes), ranker, _link(cells.get("player")), _link(cells.get("team")),
            nationality, *[cells[c].text if c in cells else None for c in _CELLS],
        )


def fbref_rows(pages: DataFrame) -> DataFrame:
    """All table rows as text, with the reason why a row is no record (NULL for records)."""
    rows = _rows_of_pages(pages, _read_stats_page, _STATS_ROW)
    player_id = text.first_group(F.col("player_href"), text.PLAYER_HREF)
    skip = (
        F.when(F.col("page_problem").isNotNull(), F.col("page_problem"))
        .when(F.array_contains(F.split("row_class", " "), "thead"), "header row")
        .when(F.col("ranker").isNull(), "no rank cell")
        .when(player_id.isNull(), "no player id")
        .when(text.blank_to_null(F.col("player")).isNull(), "no player name")
    )
    return rows.withColumn("player_id", player_id).withColumn("skip_reason", skip)


def read_fbref_pages(pages: DataFrame) -> DataFrame:
    return fbref_records(fbref_rows(pages))


def fbref_records(rows: DataFrame) -> DataFrame:
    rows = rows.filter(F.col("skip_reason").isNull())
    typed = {
        "player_id": F.col("player_id"),
        "player_name": text.blank_to_null(F.col("player")),
        "team_id": F.coalesce(text.first_group(F.col("team_href"), text.SQUAD_HREF), F.lit("")),
        "team_name": F.coalesce(text.blank_to_null(F.col("team")), F.lit("")),
        "league": F.col("league"),
        "season": F.col("season"),
        "is_multi_team_row": F.col("ranker") == "",
        "is_multi_team_total": text.is_club_total(F.col("team")),
    }
    typed |= {c: text.blank_to_null(F.col(c)) for c in _TEXT_CELLS}
    # A data cell wins over a header cell of the same name.
    typed["nationality"] = F.when(
        F.col("nationality_td").isNotNull(), text.blank_to_null(F.col("nationality_td"))
    ).otherwise(typed["nationality"])
    typed |= {c: text.grouped_int(F.col(c)) for c in _INT_CELLS}
    typed |= {c: text.grouped_double(F.col(c)) for c in _DOUBLE_CELLS}
    return rows.select(*[typed[c].alias(c) for c in FBREF_STATS.names], "url")


# --- listings of market values --------------------------------------------------------------

_LISTING_ROW = [
    "page_problem", "n_cells", "player_href", "player_name", "team_href", "team_name", "position", "birth_cell",
    "nationality", "value_cell",
]


def _linked(row: markup.Node, part: str, cls: str | None = None) -> markup.Node | None:
    """First link inside a cell (of a class) whose target contains a part."""
    for cell in row.find_all("td", cls=cls):
        for link in cell.find_all("a"):
            if part in link.attrs.get("href", ""):
                return link
    return None


def _role(row: markup.Node, player_name: str) -> str | None:
    """First text beside the name in the table nested in the name cell, else its last cell."""
    last = None
    for outer in row.find_all("td", cls="posrela"):
        for table in outer.find_all("table"):
            for cell in table.find_all("td"):
                if cell.text and cell.text != player_name:
                    return cell.text
        for inner in outer.find_all("tr"):
            last = next(inner.find_all("td"), last)
    return last.text or None if last is not None else None


def _birth_cell(row: markup.Node) -> str | None:
    texts = (cell.text for cell in row.find_all("td", cls="zentriert"))
    return next((t for t in texts if re.match(text.BIRTH_DATE, t)), None)


def _read_listing_page(html: str):
    table = markup.parse(html)[0].find("table", cls="items")
    body = table.find("tbody") if table is not None else None
    if body is None:
        yield _no_rows(table, _LISTING_ROW)
        return
    for row in body.rows():
        profile = _linked(row, "/spieler/", "hauptlink")
        named = _linked(row, "", "hauptlink")
        name = named.text if named is not None else ""
        club = _linked(row, "/verein/")
        flags = [
            flag
            for cell in row.find_all("td", cls="zentriert")
            for flag in cell.find_all("img", cls="flaggenrahmen")
        ]
        value = next((c for c in row.find_all("td", cls="rechts") if "hauptlink" in c.classes), None)
        yield (
            None,
            str(sum(1 for _ in row.find_all("td"))),
            profile.attrs["href"] if profile is not None else None,
            name,
            club.attrs["href"] if club is not None else None,
            club.attrs.get("title", club.text) if club is not None else None,
            _role(row, name),
            _birth_cell(row),
            flags[0].attrs.get("title") if flags else None,
            value.text if value is not None else None,
        )


def transfermarkt_rows(pages: DataFrame) -> DataFrame:
    rows = _rows_of_pages(pages, _read_listing_page, _LISTING_ROW)
    player_id = text.first_group(F.col("player_href"), text.PROFILE_HREF)
    team_id = text.first_group(F.col("team_href"), text.CLUB_HREF)
    skip = (
        F.when(F.col("page_problem").isNotNull(), F.col("page_problem"))
        .when(F.col("n_cells").cast("int") < 4, "too few cells")
        .when(player_id.isNull(), "no player id")
        .when(text.blank_to_null(F.col("player_name")).isNull(), "no player name")
        .when(team_id.isNull() | (F.coalesce("team_name", F.lit("")) == ""), "no team")
    )
    return (
        rows.withColumn("player_id", player_id)
        .withColumn("team_id", team_id)
        .withColumn("skip_reason", skip)
    )


def read_transfermarkt_pages(pages: DataFrame) -> DataFrame:
    return transfermarkt_records(transfermarkt_rows(pages))


def transfermarkt_records(rows: DataFrame) -> DataFrame:
    rows = rows.filter(F.col("skip_reason").isNull())
    typed = {c: F.col(c) for c in TRANSFERMARKT_VALUATIONS.names if c in rows.columns}
    typed |= {
        "date_of_birth": text.birth_date_text(F.col("birth_cell")),
        "age": text.age_in_parentheses(F.col("birth_cell")),
        "market_value_eur": text.market_value(F.col("value_cell")),
    }
    return rows.select(*[typed[c].alias(c) for c in TRANSFERMARKT_VALUATIONS.names], "url")


def total_pages(body: Column) -> Column:
    """Number of pages a listing says it has; 1 without a page list."""
    links = F.regexp_extract_all(F.regexp_extract(body, _PAGER, 1), F.lit(_PAGER_LINK), F.lit(1))
    numbers = F.transform(
        links, lambda link: F.trim(F.regexp_replace(link, "<[^>]*>", "")).try_cast("int")
    )
    return F.greatest(F.coalesce(F.array_max(numbers), F.lit(1)), F.lit(1))


# --- embedded player objects ----------------------------------------------------------------


def _player_objects(pages: DataFrame, json_text: Column) -> DataFrame:
    """One row per element of a page's list; what is no object, and a page without a list, has a reason."""
    keys = [c for c in pages.columns if c in _PAGE_KEYS]
    read = pages.select(*keys, json_text.alias("json")).withColumn("objects", text.json_objects(F.col("json")))
    problem = (
        F.when(F.col("json").isNull(), "players data not found")
        .when(F.col("objects").isNull() & F.try_parse_json("json").isNull(), "JSON error")
        .when(F.col("objects").isNull(), "unexpected format")
    )
    none = F.array(F.lit(None).cast("map<string,string>"))
    return read.withColumn("page_problem", problem).select(
        *keys, "page_problem", F.explode(F.coalesce("objects", none)).alias("player"),
    ).withColumn(
        "skip_reason", F.coalesce("page_problem", F.when(F.col("player").isNull(), "not an object"))
    )


def understat_records(rows: DataFrame) -> DataFrame:
    types = {f.name: f.dataType for f in UNDERSTAT_STATS.fields}
    typed = {"league": F.col("league"), "season": F.col("season")}
    for column, key in _UNDERSTAT_FIELDS.items():
        value = F.nullif(F.col("player")[key], F.lit(""))
        if types[column] == T.IntegerType():
            value = text.whole_number(value)
        elif types[column] == T.DoubleType():
            value = text.decimal_number(value)
        typed[column] = value
    objects = rows.filter(F.col("skip_reason").isNull())
    return objects.select(*[typed[c].alias(c) for c in UNDERSTAT_STATS.names], "url")


def understat_rows(pages: DataFrame) -> DataFrame:
    """Player objects of league pages with the hex-escaped script variable."""
    return _player_objects(pages, text.embedded_players_json(F.col("body")))


def understat_json_rows(pages: DataFrame) -> DataFrame:
    """Player objects of bodies that are plain JSON text."""
    return _player_objects(pages, F.col("body"))


def read_understat_pages(pages: DataFrame) -> DataFrame:
    """League pages with the hex-escaped script variable."""
    return understat_records(understat_rows(pages))


def read_understat_json(pages: DataFrame) -> DataFrame:
    """The same records from bodies that are plain JSON text."""
    return understat_records(understat_json_rows(pages))


for _module in (markup, text, sys.modules[__name__]):
    # Executors need no copy of this package: the readers travel with their helpers.
    cloudpickle.register_pickle_by_value(_module)
