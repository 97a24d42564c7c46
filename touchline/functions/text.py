"""Typed values out of text: numbers, money, dates, ids, escapes, JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The amounts a market value may be given in.
_MONEY_PATTERN = r"(?i)€(\d+(?:\.\d+)?)\s*(bn|m|k|Th\.)"
_MONEY_UNITS = {"bn": 1_000_000_000, "m": 1_000_000, "k": 1_000, "th.": 1_000}

# Where ids and embedded data sit in pages.
PLAYER_HREF = r"/players/([a-f0-9]+)/"
SQUAD_HREF = r"/squads/([a-f0-9]+)/"
PROFILE_HREF = r"/spieler/(\d+)"
CLUB_HREF = r"/verein/(\d+)"
PLAYERS_SCRIPT = r"var\s+playersData\s*=\s*JSON\.parse\('(.+?)'\)"
BIRTH_DATE = r"^([A-Z][a-z]{2}\s+\d{1,2},\s+\d{4})"
_AGE_IN_PARENTHESES = r"\((\d+)\)"
_CLUB_TOTAL = r"\d+\s+Clubs?"


# Text that stands for a number: decimal notation with an exponent, or one of the words for special values.
_PLAIN_NUMBER = r"^-?\d+\.?\d*$"
_NUMBER = r"(?i)^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?|nan|inf|infinity)\s*$"


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def first_group(c: Column, pattern: str) -> Column:
    """First capture group of the first hit, NULL without a hit."""
    return F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))


def whole_number(c: Column) -> Column:
    """Text to int: an integer as written, a decimal truncated, anything else NULL.

    Every 32-bit integer is exact as a double, so one cast serves both. A failing cast of text to
    int is to be avoided: it is far slower than one that succeeds.
    """
    return decimal_number(c).try_cast("int")


def decimal_number(c: Column) -> Column:
    """Text to double; a type suffix or hexadecimal digits, which a cast alone would take, give NULL."""
    # Most values are plain digits, which a short pattern tells much faster than the whole one.
    return F.when(c.rlike(_PLAIN_NUMBER) | c.rlike(_NUMBER), c.try_cast("double"))


def grouped_int(c: Column) -> Column:
    """Text to int with thousands commas; decimals are not integers and give NULL."""
    digits = F.replace(c, F.lit(","))
    return F.when(digits.rlike(r"^\s*[+-]?\d+\s*$"), digits.try_cast("int"))


def grouped_double(c: Column) -> Column:
    return decimal_number(F.replace(c, F.lit(",")))


def market_value(c: Column) -> Column:
    """'€1.50m' to 1500000; bn, m, k and Th. in any case; otherwise NULL."""
    amount = F.regexp_extract(c, _MONEY_PATTERN, 1).try_cast("double")
    unit = F.lower(F.regexp_extract(c, _MONEY_PATTERN, 2))
    factor = F.lit(None).cast("double")
    for name, value in _MONEY_UNITS.items():
        factor = F.when(unit == name, F.lit(float(value))).otherwise(factor)
    return (amount * factor).try_cast("bigint")


def decode_hex_escapes(c: Column) -> Column:
    r"""Replace every ``\xHH`` by the character with that code point.

    The text is cut into runs of escapes and runs of other characters, so an almost fully
    escaped page of n bytes becomes about n / 4000 array elements and not n.
    """
    runs = F.regexp_extract_all(
        c, F.lit(r"(?:\\x[0-9a-fA-F]{2}){1,1000}|[^\\]+|\\"), F.lit(0)
    )
    return F.array_join(
        F.transform(
            runs,
            lambda run: F.when(
                run.rlike(r"^\\x[0-9a-fA-F]{2}"),
                F.decode(F.unhex(F.replace(run, F.lit("\\x"))), "ISO-8859-1"),
            ).otherwise(run),
        ),
        "",
    )


def encode_hex_escapes(c: Column) -> Column:
    r"""Every byte of the text as ``\xHH`` (inverse of the decoder for ASCII text)."""
    return F.regexp_replace(F.lower(F.hex(F.encode(c, "UTF-8"))), "(..)", r"\\x$1")


def embedded_players_json(html: Column) -> Column:
    """JSON text of the players array that a league page carries in a script."""
    return decode_hex_escapes(first_group(html, PLAYERS_SCRIPT))


def json_objects(c: Column) -> Column:
    """JSON list as array<map<string,string>>, NULL elements where it holds no object; NULL for anything else."""
    listed = F.when(c.rlike(r"^\s*\["), c)
    elements = F.from_json(listed, "array<string>")
    one_by_one = F.transform(elements, lambda e: F.when(e.rlike(r"^\s*\{"), F.from_json(e, "map<string,string>")))
    # A list of objects alone, as pages have it, is read in one go.
    return F.coalesce(F.from_json(listed, "array<map<string,string>>"), one_by_one)


def birth_date_text(cell: Column) -> Column:
    return first_group(cell, BIRTH_DATE)


def age_in_parentheses(cell: Column) -> Column:
    return F.regexp_extract(cell, _AGE_IN_PARENTHESES, 1).try_cast("int")


def written_date(c: Column) -> Column:
    """'Jul 21, 2000' to a date."""
    return F.try_to_date(F.regexp_replace(c, r"\s+", " "), "MMM d, yyyy")


def iso_date(c: Column) -> Column:
    return F.try_to_date(c, "yyyy-M-d")


def is_club_total(team_name: Column) -> Column:
    return F.coalesce(team_name.rlike(_CLUB_TOTAL), F.lit(False))


def age_years(c: Column) -> Column:
    """Whole years of '25-123'; text without a dash is NULL."""
    return F.when(c.contains("-"), F.split_part(c, F.lit("-"), F.lit(1)).try_cast("int"))


def season_start_year(c: Column) -> Column:
    return F.split_part(c, F.lit("-"), F.lit(1))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator, denominator)
