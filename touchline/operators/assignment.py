"""One-to-one assignment of two sides by scored pairs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.operators.latest import first_per_group

Keep = Callable[[DataFrame, str], DataFrame]


def assign(pairs: DataFrame, keep: Keep, name: str = "assignment") -> DataFrame:
    """Deferred acceptance over groups of alike members: l, r, units, l_from, r_from and the other columns of ``pairs``.

    ``pairs`` has one row per pair of groups that may go together: l and r (any type with an order), score, and the
    number of members of each, l_size and r_size. Both sides prefer the greater score, then the lesser l, then the
    lesser r, so the stable assignment is unique: no pair of groups is left with a free member on both sides, and
    none would both rather have each other.

    A round settles the pairs that are the first choice of both sides, with as many units as the smaller side has
    left, and takes these units from all pairs of the two groups. The best pair of all is always among them. A round
    is written, so rounds do not add up in the plan; they go on until no pair is left. ``l_from`` and ``r_from``
    say how many members of a group were taken before: members are given out in order.
    """
    extra = [c for c in pairs.columns if c not in ("l", "r", "score", "l_size", "r_size")]
    open_pairs = keep(pairs.withColumns({"l_left": F.col("l_size"), "r_left": F.col("r_size")}), f"{name}-open-0")
    settled: list[DataFrame] = []
    while not open_pairs.isEmpty():
        turn = len(settled) + 1
        best_l = first_per_group(open_pairs, ["l"], [F.col("score").desc(), F.col("r")]).select("l", "r")
        best_r = first_per_group(open_pairs, ["r"], [F.col("score").desc(), F.col("l")])
        units = F.least("l_left", "r_left")
        both = best_r.join(best_l, ["l", "r"]).select(
            "l", "r", "score", units.alias("units"), (F.col("l_size") - F.col("l_left")).alias("l_from"),
            (F.col("r_size") - F.col("r_left")).alias("r_from"), *extra)
        both = keep(both, f"{name}-settled-{turn}")
        settled.append(both)
        taken_l = both.select("l", F.col("units").alias("_l"))
        taken_r = both.select("r", F.col("units").alias("_r"))
        rest = open_pairs.join(taken_l, "l", "left").join(taken_r, "r", "left").withColumns({
            "l_left": F.col("l_left") - F.coalesce("_l", F.lit(0)), "r_left": F.col("r_left") - F.coalesce("_r", F.lit(0)),
        }).drop("_l", "_r")
        open_pairs = keep(rest.filter("l_left > 0 and r_left > 0").select(*open_pairs.columns), f"{name}-open-{turn}")
    if not settled:
        nothing = open_pairs.select("l", "r", "score", F.col("l_left").alias("units"), F.col("l_left").alias("l_from"),
                                    F.col("r_left").alias("r_from"), *extra)
        return nothing.filter(F.lit(False))
    out = settled[0]
    for more in settled[1:]:
        out = out.union(more)
    return out


def give_out(settled: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """Members of groups that were assigned to each other: columns of ``left`` and ``right`` but for l, r and their
    places ``l_at`` and ``r_at`` (0, 1, ... in a group), with the other columns of ``settled``."""
    place = F.col("l_at") - F.col("l_from")
    here: Column = (place >= 0) & (place < F.col("units"))
    placed = left.join(settled, "l").filter(here).withColumn("r_at", (F.col("r_from") + place).cast("int"))
    return placed.join(right, ["r", "r_at"]).drop("l", "r", "l_at", "r_at", "l_from", "r_from", "units")
