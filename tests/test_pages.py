import pytest
from pyspark.sql import functions as F

import samples
from touchline.plans.warehouse import ingest_season
from touchline.schemas import FBREF_STATS, TRANSFERMARKT_VALUATIONS, UNDERSTAT_STATS
from touchline.sources import audit, markup, pages
from touchline.sources.raw_table import qualified_name, source_url_list
from touchline.sources.records import split_records


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_statistics_page(spark):
    for hidden in (False, True):
        got = pages.read_fbref_pages(samples.corpus(spark, ("fbref", samples.fbref_page(hidden))))
        expected = sorted(
            (pid, name, pos, team, tid, age, games, minutes, goals, xg, rank == "", team == "2 Clubs")
            for pid, name, pos, team, tid, age, games, minutes, goals, _, xg, rank in samples.FBREF
            if xg is not None
        )
        columns = ["player_id", "player_name", "position", "team_name", "team_id", "age", "games",
                   "minutes", "goals", "xg", "is_multi_team_row", "is_multi_team_total"]
        assert rows(got.filter("xg is not null"), *columns) == expected
        assert rows(got.filter("xg is null"), "player_name", "minutes") == [("Nils Junior", 20)]
        assert {r[0] for r in got.select("nationality").collect()} == {"nzNZL"}
        assert got.columns == [*FBREF_STATS.names, "url"]


def test_rows_that_are_no_records(spark):
    body = """<table id=stats_standard><tbody><tr><td>x</td></tr>
      <tr><th data-stat=ranker>1</th><td data-stat=player>No Link</td></tr>
      <tr><th data-stat=ranker>1</th><td data-stat=player><a href="/players/ab/"> </a></td></tr>
      <tr class="a thead"><th data-stat=ranker>Rk</th></tr>
      <tr><th data-stat=ranker>1<td data-stat=player><a href="/players/ab/">Bo &amp; Co</a>
        <td data-stat=games>x<td data-stat=minutes>1,000</tbody></table>"""
    corpus = samples.corpus(spark, ("fbref", body))
    assert rows(pages.fbref_rows(corpus).groupBy(F.coalesce("skip_reason", F.lit("record")).alias("r")).count(), "r", "count") == [
        ("header row", 1), ("no player id", 1), ("no player name", 1), ("no rank cell", 1), ("record", 1),
    ]
    got = pages.read_fbref_pages(corpus).first()
    assert (got.player_name, got.team_id, got.team_name, got.games, got.minutes) == ("Bo & Co", "", "", None, 1000)


def test_broken_pages_give_no_rows(spark):
    bodies = ["", None, "<html></html>", "<table id='stats_standard'></table>", "<<<", "<table class='items'></table>",
              "var playersData = JSON.parse('not json')", r"var playersData = JSON.parse('\x7b\x7d')"]
    corpus = samples.corpus(spark, *[("any", b) for b in bodies])
    for reader in (pages.read_fbref_pages, pages.read_transfermarkt_pages, pages.read_understat_pages,
                   pages.read_understat_json):
        assert reader(corpus).count() == 0


def test_valuation_page(spark):
    corpus = samples.corpus(spark, ("transfermarkt", samples.valuation_page()))
    expected = sorted((p, n, t, tid, pos, born, age, nat, value)
                      for p, n, t, tid, pos, born, age, nat, _, value in samples.VALUATIONS)
    got = pages.read_transfermarkt_pages(corpus)
    assert rows(got, "player_id", "player_name", "team_name", "team_id", "position", "date_of_birth",
                "age", "nationality", "market_value_eur") == expected
    assert got.columns == [*TRANSFERMARKT_VALUATIONS.names, "url"]


def test_valuation_rows_that_are_no_records(spark):
    row = ("<tr><td class='posrela'><table><tr><td class='hauptlink'><a href='{href}'>{name}</a></td></tr></table></td>"
           "<td>a</td><td>b</td><td><a href='{club}'>C</a></td></tr>")
    good = row.format(href="/x/spieler/7", name="N", club="/c/verein/9")
    body = "<table class='x items'><tbody>" + good + "<tr><td>advert</td></tr>" + "".join(
        row.format(**kw) for kw in (
            dict(href="/x/none", name="N", club="/c/verein/9"), dict(href="/x/spieler/7", name="", club="/c/verein/9"),
            dict(href="/x/spieler/7", name="N", club="/c/none"),
        )) + "</tbody></table>"
    corpus = samples.corpus(spark, ("transfermarkt", body))
    reasons = pages.transfermarkt_rows(corpus).groupBy(F.coalesce("skip_reason", F.lit("record")).alias("r")).count()
    assert rows(reasons, "r", "count") == [
        ("no player id", 1), ("no player name", 1), ("no team", 1), ("record", 1), ("too few cells", 1),
    ]
    got = pages.read_transfermarkt_pages(corpus).first()
    assert (got.player_id, got.team_name, got.position, got.market_value_eur) == ("7", "C", "N", None)


def test_script_page_and_json(spark):
    expected = sorted((r[0], r[1], r[2], r[3], r[5], r[7], r[12]) for r in samples.UNDERSTAT)
    columns = ["player_id", "player_name", "team_name", "position", "minutes", "xg", "shots"]
    html = pages.read_understat_pages(samples.corpus(spark, ("understat", samples.understat_page())))
    plain = pages.read_understat_json(samples.corpus(spark, ("understat", samples.understat_json())))
    assert rows(html, *columns) == expected == rows(plain, *columns)
    assert html.columns == [*UNDERSTAT_STATS.names, "url"]


def test_total_pages(spark):
    cases = {
        samples.valuation_page(): 3, "<p>none</p>": 1, "": 1,
        '<ul class="tm-pagination"><li><a class="x tm-pagination__link"><b> 12 </b></a></li></ul>': 12,
        '<ul class="tm-pagination-other"><a class="tm-pagination__link">9</a></ul>': 1,
    }
    df = spark.createDataFrame([(b,) for b in cases], "body string")
    assert [r[0] for r in df.select(pages.total_pages(F.col("body"))).collect()] == list(cases.values())


def test_markup_closes_what_is_left_open():
    root, comments = markup.parse("<table><tr><td>a<td>b<table><tr><td>in</table><tr><td>c</table><!--x--><p>t")
    outer = root.find("table")
    assert [[c.text for c in r.children] for r in outer.rows()] == [["a", "bin"], ["c"]]
    assert comments == ["x"] and root.find("p").text == "t"


def test_required_columns_split_records(spark):
    good = samples.understat_row(*samples.UNDERSTAT[0])
    bad = samples.understat_row(*samples.UNDERSTAT[1], player_name=None, team_name=None)
    df = samples.frame(spark, UNDERSTAT_STATS, [good, bad])
    valid, rejected = split_records(df, UNDERSTAT_STATS)
    assert rows(valid, "player_id") == [("21",)] and valid.columns == df.columns
    assert rows(rejected, "player_id", "reject_reason") == [("22", "missing player_name, team_name")]


def test_missing_pages(spark):
    listing = samples.valuation_page()
    corpus = samples.corpus(
        spark, ("transfermarkt", samples.LEAGUE, samples.SEASON, 1, "u1", listing),
        ("transfermarkt", samples.LEAGUE, samples.SEASON, 3, "u3", listing),
        ("fbref", samples.LEAGUE, samples.SEASON, 1, "f", "<html/>"),
    )
    grid = audit.expected_grid(spark)
    assert grid.count() == 3 * 5 * 3
    missing = audit.missing_pages(corpus, grid)
    ours = missing.filter((F.col("league") == samples.LEAGUE) & (F.col("season") == samples.SEASON))
    assert rows(ours, "source", "page_no") == [("transfermarkt", 2), ("understat", 1)]
    assert missing.count() == 3 * 5 * 3 + 2 - 3


def test_source_urls_follow_the_leagues(spark):
    season = samples.SEASON
    corpus = samples.corpus(
        spark, ("s", "La Liga", season, 1, "b", ""), ("s", "Premier League", season, 2, "a2", ""),
        ("s", "Premier League", season, 1, "a", ""), ("s", "Ligue 1", season, 1, "e", ""),
    )
    assert source_url_list(corpus) == "a; b; e"


def test_ingest_from_pages(spark):
    broken = samples.understat_json().replace('"player_name": "Idle Spare"', '"other": "x"')
    corpus = samples.corpus(
        spark, ("fbref", samples.fbref_page()), ("understat", broken),
        ("transfermarkt", samples.valuation_page()),
    )
    assert ingest_season(corpus, "fbref", samples.SEASON, samples.AT).row_count == 7
    result = ingest_season(corpus, "understat_json", samples.SEASON, samples.AT)
    assert (result.row_count, result.season, len(result.leagues)) == (4, samples.SEASON, 5)
    assert rows(result.rejected, "player_id", "reject_reason") == [("25", "missing player_name")]
    assert ingest_season(corpus, "transfermarkt", samples.SEASON, samples.AT).row_count == 5
    stored = spark.table(qualified_name("raw_transfermarkt__player_valuations"))
    assert {tuple(r) for r in stored.select("_season", "_source_url").collect()} == {
        (samples.SEASON, "https://corpus.example/transfermarkt")
    }
    assert ingest_season(corpus, "fbref", "2024-2025").row_count == 0
    assert spark.table(qualified_name("raw_fbref__player_season_stats")).count() == 7
    with pytest.raises(ValueError, match="1999-2000"):
        ingest_season(corpus, "fbref", "1999-2000")


def test_markup_reads_attributes_and_raw_text():
    html = """<!DOCTYPE html><script>var t = "<td>no</td>";</script><STYLE>a<b</STYLE>
    <A HREF=/x/ title='it&apos;s > "q"' checked data-stat = "n">t &amp; u</A><img src="a>b"/>after <b <i>"""
    root, _ = markup.parse(html)
    link = root.find("a")
    assert link.attrs == {"href": "/x/", "title": 'it\'s > "q"', "checked": "", "data-stat": "n"}
    assert link.text == "t & u" and root.find("td") is None
    assert root.find("img").attrs == {"src": "a>b"}


def test_broken_markup_is_read_in_linear_time():
    import time

    start = time.monotonic()
    for piece in ("a<b ", "<a '", '<td class="', "<!-- ", "<", "</", "<p x=", "<table><tr><td>"):
        markup.parse(piece * 20_000)
        markup.parse(piece * 20_000 + "<p>")
    assert time.monotonic() - start < 10


def test_pages_without_rows_have_a_reason(spark):
    listing = samples.understat_json()
    corpus = samples.corpus(
        spark, ("a", "<p>"), ("b", "<table id=stats_standard class=items>"), ("c", '[{"id": 1}, 5, null]'), ("d", "[{"),
        ("e", '{"a": 1}'), ("f", f"\n\t {listing}"), ("g", None), ("h", "[]"))
    keyed = corpus.withColumn("url", F.col("source"))

    def reasons(read):
        return dict(rows(pages.page_problems(read(keyed)), "url", "reason"))

    tables = {u: "table not found" for u in "acdefgh"} | {"b": "body not found"}
    assert reasons(pages.fbref_rows) == tables and reasons(pages.transfermarkt_rows) == tables
    assert reasons(pages.understat_rows) == {u: "players data not found" for u in "abcdefgh"}
    assert reasons(pages.understat_json_rows) == {
        "a": "JSON error", "b": "JSON error", "d": "JSON error", "e": "unexpected format", "g": "players data not found"}
    elements = pages.understat_json_rows(keyed).filter("page_problem is null")
    assert rows(elements.filter("skip_reason is not null"), "url", "skip_reason") == [("c", "not an object")] * 2
    assert pages.read_understat_json(keyed).count() == 1 + len(samples.UNDERSTAT)


def test_unreadable_pages_do_not_clear_a_season(spark):
    season = samples.SEASON
    good = samples.corpus(spark, ("understat", samples.understat_page()))
    bad = samples.corpus(spark, ("understat", "<html>a new layout</html>"))
    table = "unreadable_pages"
    assert ingest_season(good, "understat", season, table=table).row_count == 5
    with pytest.raises(ValueError, match="players data not found"):
        ingest_season(bad, "understat", season, table=table)
    assert spark.table(qualified_name(table)).count() == 5
    result = ingest_season(bad, "understat", season, table=table, allow_unreadable=True)
    assert result.row_count == 0 and result.page_problems.count() == 1


def test_a_huge_announced_number_is_one_range(spark):
    body = '<ul class=tm-pagination><li><a class=tm-pagination__link>2000000000</a></ul>'
    corpus = samples.corpus(spark, *[("transfermarkt", samples.LEAGUE, samples.SEASON, n, "u", body) for n in (2, 5)])
    grid = audit.expected_grid(spark).filter((F.col("source") == "transfermarkt") & (F.col("league") == samples.LEAGUE))
    found = audit.missing_ranges(corpus, grid.filter(F.col("season") == samples.SEASON))
    assert rows(found, "first_page", "last_page") == [(1, 1), (3, 4), (6, 2_000_000_000)]


@pytest.mark.parametrize("part", ["<b>", "</x>", "<b><td>", "<tr><b>", "<table><td><b>"])
def test_unbalanced_markup_is_read_in_linear_time(part):
    import time

    times = []
    for n in (4_000, 32_000):
        start = time.process_time()
        markup.parse("<b>" * n + part * n + "</x>" * n)
        times.append(time.process_time() - start)
    assert times[1] < 16 * max(times[0], 0.02)


class TestPlainRows:
    HEAD = '<table id="stats_standard"><tbody>'
    PLAIN = (
        '<tr class="a b"><th scope="row" data-stat="ranker">1</th><td data-stat="player" csk="x>y"><a name="n"></a>'
        '<a href="/en/players/3a/x">Zo&euml; &amp; <b> A </b></a></td><td data-stat="team"></td><td data-stat="goals">&nbsp;3 </td>'
        '<td data-stat="nationality"><a><span><span>eg</span> EGY</span></a><br></td></tr>'
    )

    def rows(self, body):
        return list(pages._read_stats_page(self.HEAD + body + "</tbody></table>"))

    def by_nodes(self, body, monkeypatch):
        with monkeypatch.context() as m:
            m.setattr(markup, "_plain_row", lambda html, begin: (None, begin))
            return self.rows(body)

    def test_cells_are_read_without_building_nodes(self, monkeypatch):
        built = []
        init = markup.Node.__init__
        with monkeypatch.context() as m:
            m.setattr(markup.Node, "__init__", lambda self, *a: (built.append(a[0]), init(self, *a))[1])
            got = self.rows(self.PLAIN * 50)
        assert len(got) == 50 and len(built) < 10
        assert got == self.by_nodes(self.PLAIN * 50, monkeypatch)
        row = dict(zip(pages._STATS_ROW, got[0]))
        assert (row["player"], row["player_href"], row["goals"], row["nationality_td"]) == (
            "Zoë &A", "/en/players/3a/x", "3", "egEGY")

    def test_markup_that_is_not_plain_gives_the_same_rows(self, monkeypatch):
        breaks = [
            "<td>", "</td>", "<tr>", "</tr>", "<a>", "</a>", "</b>", "<li>", "<table><tr><td>q", "</table>", "</tbody>", "<!-- c -->",
            "<script>", "<", '"', "'", "<td data-stat='goals'>", "<TD>", "</span>", "<p>", "<td/>", "\0",
        ]
        for broken in breaks:
            for at in range(0, len(self.PLAIN), 9):
                body = self.PLAIN + self.PLAIN[:at] + broken + self.PLAIN[at:] + self.PLAIN
                assert self.rows(body) == self.by_nodes(body, monkeypatch), (broken, at)

    def test_nodes_of_a_plain_row_are_there_when_asked_for(self):
        table = markup.parse(self.HEAD + self.PLAIN)[0].find("table")
        assert [c.tag for c in table.find("tr").children] == ["th", "td", "td", "td", "td"]
        assert [n.attrs.get("href") for n in table.find_all("a")] == [None, "/en/players/3a/x", None]
