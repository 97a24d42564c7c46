"""Fixture rows of one league and season, as pages and as raw tables."""

from datetime import UTC, datetime

from pyspark.sql import functions as F

from touchline.schemas import (
    FBREF_STATS,
    PLAYER_OVERRIDES,
    TRANSFERMARKT_VALUATIONS,
    UNDERSTAT_STATS,
    as_nullable,
)
from touchline.sources.raw_table import stamp

LEAGUE, SEASON = "Premier League", "2023-2024"
AT = datetime(2024, 7, 1, tzinfo=UTC)

# Invented players and clubs.
# player id, name, position, team, team id, age, games, minutes, goals, assists, xg, rank
FBREF = [
    ("0a1b2c3d", "Émile Varga", "FW,MF", "Northbridge", "11aa22bb", "29-101", 30, 2345, 14, 9, 13.7, "1"),
    ("0f1e2d3c", "Tomas Lindqvist", "FW", "Eastham City", "33cc44dd", "22-300", 27, 2204, 19, 4, 17.9, "2"),
    ("4b5a6978", "Željko Ćorić", "FW", "Westmoor", "55ee66ff", "26-007", 25, 1830, 9, 2, 8.8, "3"),
    ("99887766", "Rúben Soárez", "FW,MF", "2 Clubs", "", "27-150", 18, 1010, 6, 3, 5.1, "4"),
    ("99887766", "Rúben Soárez", "FW,MF", "Lagoa", "77aa88bb", "27-150", 11, 640, 4, 2, 3.3, ""),
    ("99887766", "Rúben Soárez", "FW,MF", "Vila Nóva", "99cc00dd", "27-150", 7, 370, 2, 1, 1.8, ""),
    ("a0b0c0d0", "Nils Junior", "MF", "Northbridge", "11aa22bb", "18-090", 3, 20, 0, 0, None, "5"),
]
# id, name, team, position, games, minutes, goals, xG, xA, npxG, xGChain, xGBuildup, shots, key passes
UNDERSTAT = [
    ("21", "Émile Varga", "Northbridge", "F S", 30, 2345, 14, 13.700000000000001, 7.5, 11.1, 19.5, 6.3, 80, 41),
    ("22", "Tomas Lindqvist", "Eastham City", "F S", 27, 2100, 19, 18.2, 2.9, 16.5, 21.4, 4.6, 95, 17),
    ("23", "Piet Ostrander", "Westmoor", "M C", 33, 2800, 6, 5.4, 8.1, 5.4, 15.2, 10.1, 47, 66),
    ("24", "Aram Delgado", "Northbridge", "D C", 34, 3060, 1, 1.9, 0.6, 1.9, 3.7, 3.2, 14, 7),
    ("25", "Idle Spare", "Northbridge", "Sub", 2, 0, 0, 0.0, 0.0, 0.0, 0.0, 0.0, 0, 0),
]
# id, name, team title, team id, position, birth date, age, nationality, value text, value
VALUATIONS = [
    ("700100", "Tomas Lindqvist", "Eastham City", "310", "Centre-Forward", "Feb 3, 2001", 22, "Sweden", "€95.00m", 95_000_000),
    ("700200", "Kofi Brandt", "Westmoor FC", "320", "Right Winger", "Oct 9, 1999", 24, "Ghana", "€61.50m", 61_500_000),
    ("700300", "Luca Feriani", "Porto Alto", "330", "Attacking Midfield", "Jan 30, 2002", 21, "Italy", "€45.00k", 45_000),
    ("700400", "Aram Delgado", "Northbridge FC", "340", "Centre-Back", "May 8, 1992", 31, "Spain", "€22.00m", 22_000_000),
    ("700500", "Sami Keeper", "Harbour FC", "350", "Goalkeeper", "Nov 15, 2004", 19, "Finland", "€300Th.", 300_000),
]


def frame(spark, schema, rows):
    """Rows given as dicts; missing columns are NULL."""
    data = [tuple(row.get(c) for c in schema.names) for row in rows]
    return spark.createDataFrame(data, as_nullable(schema))


def fbref_row(player_id, name, position, team, team_id, age, games, minutes, goals, assists, xg, rank="1", /, **more):
    row = dict(
        player_id=player_id, player_name=name, team_id=team_id, team_name=team, league=LEAGUE,
        season=SEASON, nationality="nz NZL", position=position, age=age, games=games,
        games_starts=games, minutes=minutes, goals=goals, assists=assists, goals_pens=goals,
        xg=xg, is_multi_team_row=rank == "", is_multi_team_total=team.endswith("Clubs"),
    )
    return row | more


def understat_row(player_id, name, team, position, games, minutes, goals, xg, xa, npxg, chain, buildup, shots, key_passes, /, **more):
    row = dict(
        player_id=player_id, player_name=name, team_name=team, league=LEAGUE, season=SEASON,
        position=position, games=games, minutes=minutes, goals=goals, xg=xg, xg_assist=xa, npxg=npxg,
        xg_chain=chain, xg_buildup=buildup, shots=shots, key_passes=key_passes,
    )
    return row | more


def valuation_row(player_id, name, team, team_id, position, born, age, nationality, text, value, /, **more):
    row = dict(
        player_id=player_id, player_name=name, team_id=team_id, team_name=team, league=LEAGUE,
        season=SEASON, position=position, date_of_birth=born, age=age, nationality=nationality,
        market_value_eur=value,
    )
    return row | more


def stamped(df, at=AT):
    """Metadata columns with the season of each row."""
    return stamp(df, SEASON, "url", at).withColumn("_season", F.col("season"))


def raw_tables(spark, fbref=None, understat=None, valuations=None):
    fbref = [fbref_row(*r) for r in FBREF] if fbref is None else fbref
    understat = [understat_row(*r) for r in UNDERSTAT] if understat is None else understat
    valuations = [valuation_row(*r) for r in VALUATIONS] if valuations is None else valuations
    return {
        "raw_fbref__player_season_stats": stamped(frame(spark, FBREF_STATS, fbref)),
        "raw_understat__player_season_stats": stamped(frame(spark, UNDERSTAT_STATS, understat)),
        "raw_transfermarkt__player_valuations": stamped(
            frame(spark, TRANSFERMARKT_VALUATIONS, valuations)
        ),
    }


def overrides(spark, *rows):
    return frame(spark, PLAYER_OVERRIDES, rows)


def fbref_page(hidden=False):
    lines = []
    for pid, name, pos, team, team_id, age, games, minutes, goals, assists, xg, rank in FBREF:
        club = f'<a href="/en/squads/{team_id}/x">{team}</a>' if team_id else team
        stats = dict(
            nationality='<span>nz</span> NZL', position=pos, age=age, games=games,
            minutes=f"{minutes:,}", goals=goals, assists=assists, xg="" if xg is None else xg,
        )
        cells = "".join(f'<td data-stat="{k}">{v}</td>' for k, v in stats.items())
        lines.append(
            f'<tr><th data-stat="ranker">{rank}</th><td data-stat="player">'
            f'<a href="/en/players/{pid}/x">{name}</a></td><td data-stat="team">{club}</td>{cells}</tr>'
        )
    lines.insert(2, '<tr class="thead"><th data-stat="ranker">Rk</th><td data-stat="player">Player</td></tr>')
    table = f'<table id="stats_standard"><thead></thead><tbody>{"".join(lines)}</tbody></table>'
    return f"<html><body><!-- a -->{'<!-- ' + table + ' -->' if hidden else table}</body></html>"


def valuation_page():
    lines = []
    for pid, name, team, team_id, pos, born, age, nat, text, _ in VALUATIONS:
        lines.append(f"""<tr><td class="zentriert">1</td>
<td class="posrela"> <table><tr><td class="hauptlink"><a href="/p/profil/spieler/{pid}">{name}</a></td></tr><tr><td>{pos}</td></tr></table> </td>
<td class="zentriert"></td><td class="zentriert">{born} ({age})</td>
<td class="zentriert"><img class="flaggenrahmen" title="{nat}" src="x.png" /></td>
<td class="zentriert"><a href="/c/startseite/verein/{team_id}" title="{team}">{team[:3]}</a></td>
<td class="rechts hauptlink">{text}</td></tr>""")
    pager = "".join(f'<li><a class="tm-pagination__link" href="/page/{i}">{i}</a></li>' for i in (1, 2, 3))
    return (
        f'<html><body><table class="items"><thead><tr><th>#</th></tr></thead><tbody>{"".join(lines)}'
        f'</tbody></table><ul class="tm-pagination">{pager}</ul></body></html>'
    )


def understat_json():
    import json

    names = ["id", "player_name", "team_title", "position", "games", "time", "goals", "xG", "xA",
             "npxG", "xGChain", "xGBuildup", "shots", "key_passes"]
    return json.dumps([dict(zip(names, map(str, r))) for r in UNDERSTAT])


def understat_page():
    escaped = "".join(f"\\x{ord(c):02x}" for c in understat_json())
    return f"<html><script>\n\tvar playersData\t= JSON.parse('{escaped}');\n</script></html>"


def corpus(spark, *pages):
    """Pages given as (source, body) or (source, league, season, page_no, url, body)."""
    rows = [
        p if len(p) == 6 else (p[0], LEAGUE, SEASON, 1, f"https://corpus.example/{p[0]}", p[1])
        for p in pages
    ]
    return spark.createDataFrame(
        rows, "source string, league string, season string, page_no int, url string, body string"
    )
