"""Page readers on corpora of pages: the given ones, and ones written from the benchmark tables.

A written page holds the rows of 25 consecutive primary keys, so its size is bounded by the keys
being unique, and pages are put together by one grouped aggregate.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions import text
from touchline.functions.names import last_token
from touchline.plans.warehouse import ingest_season
from touchline.session import shared_folder
from touchline.sources import audit, pages
from touchline.sources.seeds import LEAGUES, SEASON_LABELS
from workload.league import read
from workload.registry import query
from workload.storage_queries import summary_of

_ROWS_PER_PAGE = 25
_LEAGUES = ["Premier League", "La Liga", "Bundesliga", "Serie A", "Ligue 1"]
_SEASONS = ["2023-2024", "2024-2025", "2025-2026"]

# League and season of a page in the second engine.
_PAGE_SQL = (
    f"(['{_LEAGUES[0]}', '{_LEAGUES[1]}', '{_LEAGUES[2]}', '{_LEAGUES[3]}', '{_LEAGUES[4]}'])"
    "[(page % 5 + 1)::INT] AS league, "
    f"(['{_SEASONS[0]}', '{_SEASONS[1]}', '{_SEASONS[2]}'])[(page % 3 + 1)::INT] AS season"
)


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _corpus(rows: DataFrame, key: str, source: str, piece: Column, around) -> DataFrame:
    """``piece`` is the part of a page that a row gives; ``around`` puts a page about the parts."""
    page = F.floor(F.col(key) / _ROWS_PER_PAGE)
    grouped = (
        rows.select(page.alias("page"), F.col(key).alias("k"), piece.alias("piece"))
        .groupBy("page")
        .agg(F.array_sort(F.collect_list(F.struct("k", "piece"))).alias("parts"))
    )
    parts = F.transform("parts", lambda x: x["piece"])
    return grouped.select(
        F.lit(source).alias("source"),
        _pick(_LEAGUES, F.col("page") % 5).alias("league"),
        _pick(_SEASONS, F.col("page") % 3).alias("season"),
        (F.floor(F.col("page") / 15) + 1).cast("int").alias("page_no"),
        F.concat(F.lit(f"https://corpus.example/{source}/"), F.col("page")).alias("url"),
        around(parts, F.col("page")).alias("body"),
    )


def _tag(name: str, attrs: str, body: Column | str) -> Column:
    inner = F.lit(body) if isinstance(body, str) else body
    return F.concat(F.lit(f"<{name} {attrs}>"), inner, F.lit(f"</{name}>"))


def _hex(c: str) -> Column:
    return F.lower(F.hex(F.col(c)))


def statistics_pages(spark, sf_dir) -> DataFrame:
    k = F.col("o_orderkey")
    total = k % 13 == 0
    link = F.concat(
        F.lit('<a href="/en/players/'), _hex("o_orderkey"), F.lit('/x">Zoë &amp; '), F.col("o_orderkey"),
        F.lit("</a>"),
    )
    player = F.when(k % 17 == 0, F.concat(F.lit("Nobody "), k)).otherwise(link)
    team = F.when(total, F.lit("2 Clubs")).otherwise(
        F.concat(F.lit('<a href="/en/squads/'), _hex("o_custkey"), F.lit('/">Club '),
                 F.col("o_custkey"), F.lit("</a>"))
    )
    cells = {
        "nationality": F.lit('<span class="f-i">eg</span> EGY'),
        "position": F.when(k % 4 != 0, "FW,MF").otherwise(""),
        "age": F.concat(k % 20 + 18, F.lit("-"), F.format_string("%03d", k % 365)),
        "games": (k % 38).cast("string"),
        "minutes": F.format_number(F.floor("o_totalprice"), 0),
        "goals": F.when(k % 5 == 0, "").otherwise((k % 30).cast("string")),
        "xg": F.format_string("%.1f", (F.col("o_custkey") % 100) / 10.0),
    }
    spacer = F.when(
        k % 10 == 0, '<tr class="thead over"><th data-stat="ranker">Rk</th><td data-stat="player">Player</td></tr>'
    ).otherwise("")
    row = F.concat(
        spacer, F.lit("<tr>"),
        _tag("th", 'scope="row" data-stat="ranker"', F.when(k % 7 == 0, "").otherwise(k.cast("string"))),
        _tag("td", 'data-stat="player"', player), _tag("td", 'data-stat="team"', team),
        *[_tag("td", f'data-stat="{n}"', c) for n, c in cells.items()], F.lit("</tr>"),
    )

    def around(parts: Column, page: Column) -> Column:
        table = F.concat(
            F.lit('<table id="stats_standard"><thead><tr><th data-stat="ranker">Rk</th></tr></thead><tbody>'),
            F.array_join(parts, "\n"), F.lit("</tbody></table>"),
        )
        hidden = F.concat(F.lit("<div><!-- note --><!--\n"), table, F.lit("\n--></div>"))
        return F.concat(
            F.lit("<!DOCTYPE html><html><body><table id='other'><tr><td>x</td></tr></table>"),
            F.when(page % 4 == 0, hidden).otherwise(table), F.lit("</body></html>"),
        )

    return _corpus(read(spark, sf_dir, "orders"), "o_orderkey", "fbref", row, around)


@query(
    f"""SELECT lower(hex(o_orderkey)) AS player_id, 'Zoë & ' || o_orderkey AS player_name,
  CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE lower(hex(o_custkey)) END AS team_id,
  CASE WHEN o_orderkey % 13 = 0 THEN '2 Clubs' ELSE 'Club ' || o_custkey END AS team_name,
  {_PAGE_SQL}, 'egEGY' AS nationality, CASE WHEN o_orderkey % 4 <> 0 THEN 'FW,MF' END AS position,
  (o_orderkey % 20 + 18) || '-' || lpad((o_orderkey % 365)::VARCHAR, 3, '0') AS age,
  (o_orderkey % 38)::INT AS games, floor(o_totalprice)::INT AS minutes,
  CASE WHEN o_orderkey % 5 <> 0 THEN (o_orderkey % 30)::INT END AS goals,
  (o_custkey % 100) / 10 AS xg, o_orderkey % 7 = 0 AS is_multi_team_row,
  o_orderkey % 13 = 0 AS is_multi_team_total
FROM (SELECT *, o_orderkey // {_ROWS_PER_PAGE} AS page FROM orders) WHERE o_orderkey % 17 <> 0"""
)
def read_fbref_pages(spark, sf_dir):
    return pages.read_fbref_pages(statistics_pages(spark, sf_dir)).select(
        "player_id", "player_name", "team_id", "team_name", "league", "season", "nationality",
        "position", "age", "games", "minutes", "goals", "xg", "is_multi_team_row",
        "is_multi_team_total",
    )


@query(
    """SELECT coalesce(reason, 'record') AS reason, count(*) AS n_rows FROM (
  SELECT CASE WHEN o_orderkey % 17 = 0 THEN 'no player id' END AS reason FROM orders
  UNION ALL SELECT 'header row' FROM orders WHERE o_orderkey % 10 = 0) GROUP BY 1"""
)
def skipped_page_rows(spark, sf_dir):
    rows = pages.fbref_rows(statistics_pages(spark, sf_dir))
    return rows.groupBy(F.coalesce("skip_reason", F.lit("record")).alias("reason")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def listing_pages(spark, sf_dir) -> DataFrame:
    k, name = F.col("c_custkey"), F.col("c_name")
    nested = F.concat(
        F.lit('<table><tr><td class="hauptlink"><a href="/x/profil/spieler/'), k, F.lit('">'), name,
        F.lit("</a></td></tr><tr><td>"), F.initcap("c_mktsegment"), F.lit("</td></tr></table>"),
    )
    born = F.concat(
        F.date_format(F.date_add(F.lit("1990-01-01").cast("date"), (k % 5000).cast("int")), "MMM d, yyyy"),
        F.lit(" ("), k % 20 + 15, F.lit(")"),
    )
    club = F.when(
        k % 9 != 0,
        F.concat(F.lit('<a href="/c/startseite/verein/'), F.col("c_nationkey"), F.lit('" title="Club '),
                 F.col("c_nationkey"), F.lit('">C</a>')),
    ).otherwise("without club")
    value = F.when(k % 8 == 0, "-").otherwise(
        F.concat(F.lit("€"), F.format_string("%.2f", F.abs("c_acctbal")), F.lit("k"))
    )
    row = F.concat(
        F.lit("<tr>"), _tag("td", 'class="zentriert"', k.cast("string")),
        _tag("td", 'class="posrela"', nested), _tag("td", 'class="zentriert"', ""),
        _tag("td", 'class="zentriert"', F.when(k % 6 == 0, "unknown").otherwise(born)),
        F.lit('<td class="zentriert"><img class="flaggenrahmen" title="Norway"/><img class="flaggenrahmen" title="Peru"/></td>'),
        _tag("td", 'class="zentriert"', club), _tag("td", 'class="rechts hauptlink"', value),
        F.lit("</tr><tr><td>advert</td></tr>"),
    )

    def around(parts: Column, page: Column) -> Column:
        return F.concat(
            F.lit('<html><body><table class="items"><thead><tr><th>#</th></tr></thead><tbody>'),
            F.array_join(parts, ""), F.lit("</tbody></table></body></html>"),
        )

    return _corpus(read(spark, sf_dir, "customer"), "c_custkey", "transfermarkt", row, around)


@query(
    f"""SELECT c_custkey::VARCHAR AS player_id, c_name AS player_name,
  c_nationkey::VARCHAR AS team_id, 'Club ' || c_nationkey AS team_name, {_PAGE_SQL},
  upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS position,
  CASE WHEN c_custkey % 6 <> 0 THEN strftime(DATE '1990-01-01' + (c_custkey % 5000)::INT, '%b %-d, %Y') END
    AS date_of_birth, 'Norway' AS nationality,
  CASE WHEN c_custkey % 6 <> 0 THEN (c_custkey % 20 + 15)::INT END AS age,
  CASE WHEN c_custkey % 8 <> 0 THEN trunc(abs(c_acctbal) * 1000)::BIGINT END AS market_value_eur
FROM (SELECT *, c_custkey // {_ROWS_PER_PAGE} AS page FROM customer) WHERE c_custkey % 9 <> 0"""
)
def read_transfermarkt_pages(spark, sf_dir):
    return pages.read_transfermarkt_pages(listing_pages(spark, sf_dir)).drop("url")


def script_pages(spark, sf_dir, escaped: bool = True) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size")
    player = F.struct(
        k.cast("string").alias("id"), F.col("p_name").alias("player_name"),
        F.col("p_brand").alias("team_title"), F.lit("F S").alias("position"),
        F.when(k % 3 == 0, F.concat(size, F.lit(".0"))).otherwise(size.cast("string")).alias("games"),
        F.when(k % 4 == 0, "").otherwise((size * 90).cast("string")).alias("time"),
        F.col("p_retailprice").cast("string").alias("xG"), (size * 2).alias("shots"),
    )

    def around(parts: Column, page: Column) -> Column:
        whole = F.concat(F.lit("["), F.array_join(parts, ","), F.lit("]"))
        # Every seventh page is cut off and gives no rows.
        body = F.when(page % 7 == 3, F.expr("'[{'")).otherwise(whole)
        if not escaped:
            # Bodies may begin with white space.
            return F.concat(F.when(page % 2 == 0, "\n\t ").otherwise(""), body)
        return F.concat(
            F.lit("<html><script>\n\tvar playersData\t= JSON.parse('"), text.encode_hex_escapes(body),
            F.lit("');\n</script></html>"),
        )

    return _corpus(read(spark, sf_dir, "part"), "p_partkey", "understat", F.to_json(player), around)


_SCRIPT_SQL = f"""SELECT p_partkey::VARCHAR AS player_id, p_name AS player_name, p_brand AS team_name,
  {_PAGE_SQL}, 'F S' AS position, p_size AS games,
  CASE WHEN p_partkey % 4 <> 0 THEN p_size * 90 END AS minutes, p_retailprice AS xg,
  p_size * 2 AS shots
FROM (SELECT *, p_partkey // {_ROWS_PER_PAGE} AS page FROM part) WHERE page % 7 <> 3"""
_SCRIPT_COLUMNS = [
    "player_id", "player_name", "team_name", "league", "season", "position", "games", "minutes",
    "xg", "shots",
]


@query(_SCRIPT_SQL)
def read_understat_pages(spark, sf_dir):
    return pages.read_understat_pages(script_pages(spark, sf_dir)).select(*_SCRIPT_COLUMNS)


@query(_SCRIPT_SQL)
def read_understat_json(spark, sf_dir):
    return pages.read_understat_json(script_pages(spark, sf_dir, False)).select(*_SCRIPT_COLUMNS)


@query(
    r"""SELECT page_id, lang, title, string_split(title, ' ')[-1] AS last_word,
  unnest(regexp_extract_all(html, '<a href="/([^"]*)"', 1)) AS target
FROM (SELECT page_id, html, nullif(regexp_extract(html, '<html[^>]* lang="([^"]*)"', 1), '') AS lang,
  nullif(trim(replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '&amp;', '&')), '') AS title
  FROM pages)"""
)
def page_links(spark, sf_dir):
    html = F.col("html")
    title = F.replace(F.regexp_extract(html, "<title>([^<]*)</title>", 1), F.lit("&amp;"), F.lit("&"))
    return (
        read(spark, sf_dir, "pages")
        .select(
            "page_id",
            text.first_group(html, '<html[^>]* lang="([^"]*)"').alias("lang"),
            text.blank_to_null(title).alias("title"),
            F.explode(F.regexp_extract_all(html, F.lit('<a href="/([^"]*)"'), F.lit(1))).alias("target"),
        )
        .select("page_id", "lang", "title", last_token(F.col("title")).alias("last_word"), "target")
    )


@query(
    """WITH present AS (SELECT DISTINCT c_nationkey, (c_custkey // 25) * 2 + 1 AS page_no FROM customer),
announced AS (SELECT n_nationkey, n_name, coalesce(max(page_no) + 1, 1) AS n FROM nation
  LEFT JOIN present ON c_nationkey = n_nationkey GROUP BY ALL)
SELECT league, page_no::INT AS page_no FROM (
  SELECT n_nationkey, n_name AS league, unnest(range(1, n + 1)) AS page_no FROM announced)
WHERE (n_nationkey, page_no) NOT IN (SELECT (c_nationkey, page_no) FROM present)"""
)
def missing_pages(spark, sf_dir):
    nations = read(spark, sf_dir, "nation").select(
        F.lit("transfermarkt").alias("source"), F.col("n_name").alias("league"),
        F.lit("2023-2024").alias("season"), "n_nationkey",
    )
    # Every other page number is there.
    present = (
        read(spark, sf_dir, "customer")
        .select(
            F.col("c_nationkey").alias("n_nationkey"),
            (F.floor(F.col("c_custkey") / 25) * 2 + 1).cast("int").alias("page_no"),
        )
        .distinct()
    )

    def pager(of_list: str, of_link: str) -> Column:
        item = f'<li><a class={of_link} href="#"> '
        return F.concat(
            F.lit(f"<div><ul class={of_list}>" + item), F.lit("1</a></li>"), F.lit(item),
            F.lit("next</a></li>"), F.lit(item + "<b>"), F.col("page_no") + 1,
            F.lit(" </b></a></li></ul></div>"),
        )

    quoting = F.col("page_no") % 3
    body = (
        F.when(quoting == 0, pager('"x tm-pagination"', '"tm-pagination__link tm-active"'))
        .when(quoting == 1, pager("'tm-pagination'", "'x tm-pagination__link'"))
        .otherwise(pager("tm-pagination", "tm-pagination__link"))
    )
    corpus = present.join(nations, "n_nationkey").select(
        "source", "league", "season", "page_no", body.alias("body")
    )
    return audit.missing_pages(corpus, nations.drop("n_nationkey")).select("league", "page_no")


@query(
    f"""WITH grid AS (SELECT source, league, season
  FROM (SELECT unnest({list(audit.SOURCE_LEAGUE_KEYS)}) AS source),
  (SELECT unnest({LEAGUES}) AS league), (SELECT unnest({SEASON_LABELS}) AS season)),
seen AS (SELECT DISTINCT {list(audit.SOURCE_LEAGUE_KEYS)}[o_orderkey % 3 + 1] AS source,
  {LEAGUES}[o_custkey % 4 + o_orderkey % 3 // 2 + 1] AS league,
  {SEASON_LABELS}[o_orderkey % 3 + 1 - o_orderkey % 3 // 2] AS season FROM orders)
SELECT source, league, season FROM grid EXCEPT SELECT source, league, season FROM seen"""
)
def expected_grid(spark, sf_dir):
    def pick(values: list[str], at: Column) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), (at + 1).cast("int"))

    # Some leagues and seasons of a source never occur.
    third = F.col("o_orderkey") % 3
    late = F.floor(third / 2)
    corpus = read(spark, sf_dir, "orders").select(
        pick(list(audit.SOURCE_LEAGUE_KEYS), third).alias("source"),
        pick(LEAGUES, F.col("o_custkey") % 4 + late).alias("league"),
        pick(SEASON_LABELS, third - late).alias("season"),
        F.lit(1).alias("page_no"), F.lit("").alias("body"),
    )
    return audit.missing_pages(corpus, audit.expected_grid(spark)).select("source", "league", "season")


@query(
    f"""SELECT 'fbref' AS source, url, 'table not found' AS reason FROM pages
UNION ALL
SELECT 'understat', 'https://corpus.example/understat/' || page, 'JSON error'
FROM (SELECT DISTINCT p_partkey // {_ROWS_PER_PAGE} AS page FROM part) WHERE page % 7 = 3"""
)
def page_problems(spark, sf_dir):
    foreign = read(spark, sf_dir, "pages").select(
        F.lit("").alias("league"), F.lit("").alias("season"), F.lit(1).alias("page_no"), "url",
        F.col("html").alias("body"),
    )
    return (
        pages.page_problems(pages.fbref_rows(foreign)).withColumn("source", F.lit("fbref"))
        .union(
            pages.page_problems(pages.understat_rows(script_pages(spark, sf_dir)))
            .withColumn("source", F.lit("understat"))
        )
        .select("source", "url", "reason")
    )


@query(
    f"""SELECT season AS _season, (SELECT string_agg('https://corpus.example/understat/' || page, '; '
    ORDER BY page % 5) FROM (SELECT DISTINCT p_partkey // {_ROWS_PER_PAGE} AS page FROM part)
    WHERE page < 15 AND page % 3 = 1) AS _source_url,
  count(*) AS n_rows, sum(minutes) AS minutes, count(DISTINCT player_id) AS n_players
FROM ({_SCRIPT_SQL}) WHERE season = '2024-2025' GROUP BY season"""
)
def ingest_pages(spark, sf_dir):
    table, location = f"pages_{uuid.uuid4().hex}", shared_folder(spark)
    ingest_season(script_pages(spark, sf_dir), "understat", "2024-2025", location=location, table=table)
    return summary_of(spark, table, lambda stored: (
        stored.filter(F.col("_season") == "2024-2025").groupBy("_season", "_source_url")
        .agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum("minutes").alias("minutes"),
            F.countDistinct("player_id").alias("n_players"),
        )
    ))
