import datetime
import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from touchline.functions import names, positions, text
from touchline.functions.keys import surrogate_key
from touchline.functions.similarity import jaro_winkler, jaro_winkler_arrays


def run(spark, column, values, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"c {kind}")
    return [r[0] for r in df.select(column(F.col("c"))).collect()]


def check(spark, column, cases, kind="string"):
    assert run(spark, column, list(cases), kind) == list(cases.values())


def test_market_value(spark):
    check(spark, text.market_value, {
        "€180.00m": 180_000_000, "€1.50m": 1_500_000, "€25.00k": 25_000, "€500Th.": 500_000,
        "€1.20bn": 1_200_000_000, "€3.5BN": 3_500_000_000, None: None, "": None,
        "not a value": None, "-": None,
    })


def test_hex_escapes(spark):
    check(spark, text.decode_hex_escapes, {
        r"\x48\x65\x6c\x6c\x6f": "Hello", r"abc\x20def": "abc def", "plain é text": "plain é text",
        r"\xE9\xe8": "éè", r"a\b\x4": r"a\b\x4", r"\\x41": "\\A", "": "", None: None,
    })


def test_hex_escapes_of_a_long_text(spark):
    body = "".join(f"\\x{i % 96 + 32:02x}" for i in range(300_000)) + "é" * 50_000
    expected = "".join(chr(i % 96 + 32) for i in range(300_000)) + "é" * 50_000
    assert run(spark, text.decode_hex_escapes, [body]) == [expected]


def test_normalised_names(spark):
    check(spark, names.normalize_player_name, {
        "José María": "jose maria", "Østby": "østby", "  Müller ": "muller", "": "",
        "é": "e", "Şenol Çağrı": "senol cagrı", None: None,
    })
    check(spark, names.ascii_name, {
        "José María": "jose maria", "Müller": "muller", "Çağrı": "cagri",
        "  Émile   Varga  ": "emile varga", "": "", "é": "e", "Željko Ćorić": "zeljko coric",
        "Østby": "ostby", "Straße Łódź": "strasse lodz", "Æsir": "aesir",
    })


def test_accents_agree_with_the_second_engine_on_every_latin_letter(spark):
    letters = [chr(c) for c in [*range(0x20, 0x250), *range(0x300, 0x370), *range(0x1E00, 0x1F00)]]
    frame = pd.DataFrame({"c": letters})
    expected = [r[0] for r in duckdb.sql("SELECT strip_accents(c) FROM frame").fetchall()]
    assert run(spark, names.strip_accents, letters) == expected


def test_team_names(spark):
    check(spark, names.ascii_team_name, {
        "FC Barcelona": "barcelona", "Liverpool FC": "liverpool", "SC Freiburg": "freiburg",
        "AC Milan": "milan", "RCD Mallorca": "mallorca", "Atlético Madrid": "atletico madrid",
        "1. FC Köln": "koln", "Arsenal": "arsenal", "CF Montréal": "montreal",
    })


def test_last_token(spark):
    check(spark, names.last_token, {"a b c": "c", "single": "single", "": "", "x ": ""})


def test_numbers(spark):
    check(spark, text.whole_number, {"3": 3, "3.0": 3, "3.7": 3, "x": None, "NaN": None, None: None})
    check(spark, text.decimal_number, {"3": 3.0, "3.25": 3.25, "x": None})
    check(spark, text.grouped_int, {"2,614": 2614, "1,234,567": 1234567, "16.2": None, "": None})
    check(spark, text.grouped_double, {"1,234.5": 1234.5, "x": None})


def test_ages_and_dates(spark):
    check(spark, text.age_years, {"25-123": 25, "27": None, None: None, "x-1": None})
    check(spark, text.season_start_year, {"2023-2024": "2023"})
    check(spark, lambda c: text.written_date(text.birth_date_text(c)), {
        "Jul 21, 2000 (23)": datetime.date(2000, 7, 21), "Sep 5, 2001": datetime.date(2001, 9, 5),
        "born Sep 5, 2001": None, "": None,
    })
    check(spark, text.iso_date, {"2000-07-21": datetime.date(2000, 7, 21), "2000-7-1": datetime.date(2000, 7, 1),
                                 "Jul 21, 2000": None, "2000-13-01": None})
    check(spark, text.age_in_parentheses, {"Jul 21, 2000 (23)": 23, "Jul 21, 2000": None})
    check(spark, text.is_club_total, {"2 Clubs": True, "1 Club": True, "Club 2": False, None: False})


def test_json_objects(spark):
    check(spark, lambda c: F.size(text.json_objects(c)), {
        '[{"a": 1}, {"a": "x"}]': 2, "[]": 0, '{"a": 1}': None, "": None, "[{": None, None: None,
    })
    values = run(spark, lambda c: text.json_objects(c)[0]["a"], ['[{"a": 1.50}]', '[{"a": null}]'])
    assert values == ["1.5", None]


def test_positions(spark):
    check(spark, positions.position_group, {
        "F S": "Forward", "M": "Midfielder", "D C": "Defender", "GK": "Goalkeeper", "GK S": "Goalkeeper",
        "Sub": "Substitute", "S": "S", None: None,
    })
    pairs = {
        ("FW,MF", "Midfielder"): 1.0, ("FW", "Forward"): 1.0, ("DF", "Forward"): 0.0,
        (None, "Forward"): 0.5, ("GK", None): 0.5,
    }
    df = spark.createDataFrame(list(pairs), "a string, b string")
    scores = df.select(positions.group_compatibility(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in scores] == list(pairs.values())


@pytest.mark.parametrize("scores, total, band", [
    ((1.0, 1.0, 1.0), 0.9999999999999999, "auto_matched"),
    ((1.0, 1.0, 0.5), 0.95, "auto_matched"),
    ((1.0, 1.0, 0.0), 0.8999999999999999, "review_needed"),
    ((1.0, 0.0, 1.0), 0.7, "review_needed"),
])
def test_composite_score(spark, scores, total, band):
    score = positions.composite_score(*map(F.lit, scores))
    assert spark.range(1).select(score, positions.match_band(score)).first()[:] == (total, band)


def test_surrogate_key(spark):
    one = spark.range(1).select(
        surrogate_key(F.lit("2023-2024")), surrogate_key(F.lit("Premier League")),
        surrogate_key(F.lit("manchester city"), F.lit("Premier League")),
        surrogate_key(F.lit("b66315ae")), surrogate_key(F.lit(None), F.lit(1)),
    ).first()
    assert one[:4] == (
        "39511cc89f06f4b3dddfe8b5453160b4", "1f85e0f020e143beddcebd01720b9493",
        "4ecadd4dc3e3d83634ce77ecc84a4e56", "c4c1ffa1d6bee43352c6630378efbcb6",
    )
    assert one[4] is not None


def test_similarity_values(spark):
    cases = {
        ("martha", "marhta"): 0.9611111111111111, ("dwayne", "duane"): 0.84,
        ("dixon", "dicksonx"): 0.8133333333333332, ("abxyzq", "abpqrs"): 0.6666666666666666,
        ("joão", "joao"): 0.8266666666666667, ("son heung-min", "heung-min son"): 0.7128205128205128,
        ("", ""): 0.0, ("a", None): None, ("same", "same"): 1.0, ("ab", "xy"): 0.0,
    }
    df = spark.createDataFrame(list(cases), "a string, b string")
    got = [r[0] for r in df.select(jaro_winkler(F.col("a"), F.col("b"))).collect()]
    assert got == pytest.approx(list(cases.values()), abs=1e-15)


def test_similarity_agrees_with_the_second_engine_to_the_bit():
    rng = random.Random(7)
    alphabet = "abcdeéøñ -"

    def word(n):
        return "".join(rng.choice(alphabet) for _ in range(rng.randint(0, n)))

    pairs = [(word(20), word(90)) for _ in range(3000)]
    for _ in range(7000):
        a = list(word(24))
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            b.insert(rng.randint(0, len(b)), rng.choice(alphabet))
        pairs.append(("".join(a), "".join(b)))
    frame = pd.DataFrame(pairs, columns=["a", "b"])
    expected = duckdb.sql("SELECT jaro_winkler_similarity(a, b) AS s FROM frame").df()["s"]
    got = jaro_winkler_arrays([a.encode() for a in frame.a], [b.encode() for b in frame.b])
    assert (got == expected.to_numpy()).all()
