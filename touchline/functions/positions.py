"""Position groups, compatibility scores and match bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# First token of a position code and the group it stands for.
_GROUP_OF_TOKEN = {"F": "Forward", "M": "Midfielder", "D": "Defender"}

# Which groups (first source) and roles (second source) agree with a position code.
_GROUPS_OF_CODE = {
    "FW": ["Forward"],
    "MF": ["Midfielder"],
    "DF": ["Defender"],
    "GK": ["Goalkeeper"],
}
_ROLES_OF_CODE = {
    "FW": ["Centre-Forward", "Left Winger", "Right Winger", "Second Striker"],
    "MF": [
        "Central Midfield", "Attacking Midfield", "Defensive Midfield", "Left Midfield",
        "Right Midfield",
    ],
    "DF": ["Centre-Back", "Left-Back", "Right-Back"],
    "GK": ["Goalkeeper"],
}

# Weights and limits of the match score.
NAME_WEIGHT, TEAM_WEIGHT, POSITION_WEIGHT = 0.6, 0.3, 0.1
KEEP_SCORE, AUTO_SCORE = 0.75, 0.90


def position_group(code: Column) -> Column:
    token = F.split_part(code, F.lit(" "), F.lit(1))
    out = F.when(code.isNull(), F.lit(None).cast("string")).when(
        (code == "GK") | code.startswith("GK "), "Goalkeeper"
    )
    for short, group in _GROUP_OF_TOKEN.items():
        out = out.when(token == short, group)
    return out.when(code == "Sub", "Substitute").otherwise(code)


def _compatibility(code: Column, other: Column, table: dict[str, list[str]]) -> Column:
    out = F.when(code.isNull() | other.isNull(), F.lit(0.5))
    for short, accepted in table.items():
        out = out.when(code.contains(short) & other.isin(accepted), F.lit(1.0))
    return out.otherwise(F.lit(0.0))


def group_compatibility(code: Column, group: Column) -> Column:
    return _compatibility(code, group, _GROUPS_OF_CODE)


def role_compatibility(code: Column, role: Column) -> Column:
    return _compatibility(code, role, _ROLES_OF_CODE)


def team_overlap(linked_team: Column) -> Column:
    return F.when(linked_team.isNotNull(), F.lit(1.0)).otherwise(F.lit(0.0))


def composite_score(name: Column, team: Column, position: Column) -> Column:
    """Weighted score in double arithmetic. The order of the sum decides the band of scores
    that sit on a limit, so it must not be rearranged."""
    return F.lit(NAME_WEIGHT) * name + F.lit(TEAM_WEIGHT) * team + F.lit(POSITION_WEIGHT) * position


def match_band(score: Column) -> Column:
    return F.when(score >= AUTO_SCORE, "auto_matched").otherwise("review_needed")
