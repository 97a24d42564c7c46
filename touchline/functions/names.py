"""Name normalisation."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Latin letters and punctuation without a canonical decomposition and
# their ASCII spelling, applied to lower-case text by ``ascii_name``.
_ASCII_SINGLE = {
    "ø": "o", "ł": "l", "đ": "d", "ð": "d", "ħ": "h", "ı": "i", "ĸ": "k", "ŧ": "t",
    "ſ": "s", "ƀ": "b", "ƒ": "f", "ɨ": "i", "ƶ": "z", "ə": "e",
    "‘": "'", "’": "'", "‚": ",", "“": '"', "”": '"', "–": "-", "‐": "-", "‑": "-",
    " ": " ",
}
_ASCII_MULTI = {
    "ß": "ss", "æ": "ae", "œ": "oe", "þ": "th", "ĳ": "ij", "ŋ": "ng", "ŉ": "'n", "—": "--",
}

# Words around a club name that carry no identity.
_CLUB_PREFIX = r"^(1\.\s*fc|fc|cf|sc|ac|as|ss|ssc|us|rc|rcd|ca|cd|afc)[\s.]"
_CLUB_SUFFIX = r"\s+(fc|cf|sc|ac)$"


@lru_cache(maxsize=1)
def _accent_table() -> tuple[str, str]:
    """Precomposed Latin letters and their base letters, derived from Unicode NFD."""
    src, dst = [], []
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        ch = chr(code)
        base = "".join(c for c in unicodedata.normalize("NFD", ch) if not unicodedata.combining(c))
        if len(base) == 1 and base != ch:
            src.append(ch)
            dst.append(base)
    return "".join(src), "".join(dst)


def strip_accents(c: Column) -> Column:
    """Latin letters without their diacritics; letters that do not decompose stay (ø, ł, ß).

    Text of one byte per character is ASCII and passes untouched, which is most of it.
    """
    src, dst = _accent_table()
    bare = F.regexp_replace(F.translate(c, src, dst), r"\p{M}+", "")
    return F.when(F.octet_length(c) == F.char_length(c), c).otherwise(bare)


def normalize_player_name(c: Column) -> Column:
    return F.trim(F.lower(strip_accents(c)))


def normalize_team_name(c: Column) -> Column:
    return F.trim(F.lower(strip_accents(c)))


def ascii_name(c: Column) -> Column:
    """ASCII transliteration of Latin text, lower case, whitespace collapsed and stripped."""
    out = strip_accents(F.lower(c))
    out = F.translate(out, "".join(_ASCII_SINGLE), "".join(_ASCII_SINGLE.values()))
    for letter, spelling in _ASCII_MULTI.items():
        out = F.replace(out, F.lit(letter), F.lit(spelling))
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def strip_club_affixes(c: Column) -> Column:
    """Drop one club prefix, then one club suffix, from an already lower-case name."""
    without_prefix = F.regexp_replace(c, "(?i)" + _CLUB_PREFIX, "")
    return F.trim(F.regexp_replace(without_prefix, "(?i)" + _CLUB_SUFFIX, ""))


def ascii_team_name(c: Column) -> Column:
    return strip_club_affixes(ascii_name(c))


def last_token(c: Column) -> Column:
    """Text after the last space; the empty string stays empty."""
    return F.substring_index(c, " ", -1)
