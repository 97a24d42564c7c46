"""The bound of the similarity, the assignment, clubs by affix-free names and hashed uniqueness beside plain versions."""

import random

import pytest
from pyspark.sql import functions as F

import samples
from samples import fbref_row, understat_row
from touchline.functions.similarity import jaro_winkler, jaro_winkler_arrays, jaro_winkler_bound, letter_mask
from touchline.operators import quality
from touchline.operators.assignment import assign, give_out
from touchline.plans import players, teams
from touchline.plans.warehouse import Warehouse
from touchline.session import shared_folder, written
from touchline.sources.seeds import player_overrides, team_aliases


def bound(left="l", right="r"):
    return jaro_winkler_bound(F.col(left), F.col(right), letter_mask(left), letter_mask(right))


def test_the_bound_is_never_below_the_similarity(spark):
    rng = random.Random(2)
    names = ["".join(rng.choice("aabcdeéñ -'xyzØ7") for _ in range(rng.randint(1, 16))) for _ in range(150)]
    names += ["martha", "marhta", "dwayne", "duane", "aaaa", "aaaab", "é", "éé", "日本", "日木"]
    pairs = [(x, y) for x in names for y in names]
    got = spark.createDataFrame(pairs, "l string, r string").select("l", "r", bound().alias("b")).collect()
    true = jaro_winkler_arrays([x.encode() for x, _ in pairs], [y.encode() for _, y in pairs])
    assert len(got) == len(pairs) and all(r.b >= s - 1e-9 for r, s in zip(got, true))
    assert sum(r.b < 0.75 for r in got) > 0.4 * len(pairs)


def test_the_bound_skips_pairs_that_cannot_be_kept(spark):
    """Players of one last name and club: matches are the same, and most pairs do not reach the similarity."""
    rng = random.Random(3)
    first = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 8))) for _ in range(120)]
    hub = spark.createDataFrame(
        [("L", "s", "t1", f"{x} silva", "FW", "silva") for x in first[:80]],
        "league string, season string, fbref_team_id string, hub_name string, position_mark string, last_name string",
    ).withColumn("other_team", F.lit("T"))
    other = spark.createDataFrame(
        [("L", "s", "T", f"{x} silva", "Defender", f"u{i}", "silva") for i, x in enumerate(first[40:])],
        "league string, season string, other_team string, other_name string, other_position string, other_id string, last_name string")
    both = {}
    for bounded in (False, True):
        pairs = players._similar(players._lettered(hub, "hub"), players._lettered(other, "other"), players.UNDERSTAT, 1000, players.as_is, bounded)
        rows = pairs.select("hub_name", "other_name", "composite_score").collect()
        both[bounded] = len(rows), sorted(r for r in rows if r.composite_score >= players.KEEP_SCORE)
    assert both[False][1] == both[True][1] and len(both[True][1]) >= 40
    assert both[False][0] == 80 * 80 and both[True][0] < 0.6 * both[False][0]


def plain_assignment(edges, l_size, r_size):
    """Pairs of members, taken one by one in the order that both sides prefer."""
    left, right = dict.fromkeys(l_size, 0), dict.fromkeys(r_size, 0)
    out = []
    for _, a, b in sorted((-s, a, b) for a, b, s in edges):
        while left[a] < l_size[a] and right[b] < r_size[b]:
            out.append((a, left[a], b, right[b]))
            left[a], right[b] = left[a] + 1, right[b] + 1
    free = [(a, b) for a, b, _ in edges if left[a] < l_size[a] and right[b] < r_size[b]]
    return out, free


@pytest.mark.parametrize("seed", range(4))
def test_assignment(spark, seed):
    rng = random.Random(seed)
    l_size = {f"a{i}": rng.choice([1, 1, 1, 2, 4]) for i in range(25)}
    r_size = {i: rng.choice([1, 1, 3]) for i in range(25)}
    edges = [(a, b, rng.randint(1, 6) / 8) for a in l_size for b in r_size if rng.random() < 0.15]
    folder = shared_folder(spark)
    pairs = spark.createDataFrame(
        [(a, b, s, l_size[a], r_size[b], f"{a}-{b}") for a, b, s in edges],
        "l string, r int, score double, l_size long, r_size long, note string")
    settled = assign(pairs, lambda df, name: written(df, folder, name))
    members = [
        spark.createDataFrame([(g, i, f"{g}/{i}") for g, n in sizes.items() for i in range(n)], f"{s} {kind}, {s}_at int, {s}_id string")
        for s, kind, sizes in (("l", "string", l_size), ("r", "int", r_size))]
    got = {(r.l_id, r.r_id, r.note) for r in give_out(settled, *members).collect()}
    want, free = plain_assignment(edges, l_size, r_size)
    assert free == [] and got == {(f"{a}/{i}", f"{b}/{j}", f"{a}-{b}") for a, i, b, j in want}
    assert assign(pairs.limit(0), players.as_is).count() == 0


def test_a_loser_gets_the_next_best(spark):
    """Two players prefer one id; the loser is given the other one, and nobody the id of a manual match."""
    fbref = [("p1", "Jan Silva"), ("p2", "Jana Silva"), ("p3", "Janis Silva")]
    understat = [("u1", "Jan Silva"), ("u2", "Janus Silva"), ("u3", "Janis Silva")]
    raw = samples.raw_tables(
        spark, fbref=[fbref_row(i, n, "FW", "Arsenal", "t1", "20-001", 1, 90, 1, 0, 0.5) for i, n in fbref],
        understat=[understat_row(i, n, "Arsenal", "F S", 1, 90, 1, 0.5, 0.1, 0.5, 1.0, 0.5, 3, 1) for i, n in understat],
        valuations=[])

    def matched(**options):
        w = Warehouse(raw, team_aliases(spark), options.pop("overrides", player_overrides(spark)), **options)
        return {r.fbref_player_id: r.understat_player_id for r in w["int_player_xref"].collect()}

    assert matched() == {"p1": "u1", "p2": "u1", "p3": "u3"}
    assert matched(one_to_one=True) == {"p1": "u1", "p2": None, "p3": "u3"}
    assert matched(assign=True) == {"p1": "u1", "p2": "u2", "p3": "u3"}
    manual = samples.frame(spark, samples.PLAYER_OVERRIDES, [
        {"fbref_player_id": "p3", "understat_player_id": "u1", "canonical_player_id": "p3", "override_reason": "x"}])
    assert matched(assign=True, overrides=manual) == {"p1": "u3", "p2": "u2", "p3": "u1"}


def test_clubs_by_affix_free_names(spark):
    def names(*pairs):
        return spark.createDataFrame([(f"t{i}", n, g) for i, (n, g) in enumerate(pairs)], "fbref_team_id string, team_name string, league string")

    hub = names(("fc porto", "A"), ("milan", "A"), ("ac milan", "B"), ("milan fc", "B"), ("exact", "A"), ("fc exact", "A"), ("fc", "A"))
    other = names(("pôrto", "A"), ("ac milan", "A"), ("milan", "B"), ("exact", "A"), ("exact sc", "A"), ("known as x", "A"), ("sc", "A"))
    aliases = spark.createDataFrame([("understat", "known as x", "fc exact", "A")], "source string, source_team_name string, canonical_team_name string, league string")
    none = other.limit(0).withColumnRenamed("fbref_team_id", "transfermarkt_team_id")

    def found(ladder):
        rows = teams.team_xref(hub, other, none, aliases, ladder).collect()
        return sorted((r.fbref_team_name, r.league, r.understat_team_name) for r in rows)

    plain = {("exact", "A"): "exact", ("fc exact", "A"): "known as x"}
    rung = plain | {("fc porto", "A"): "pôrto", ("milan", "A"): "ac milan"}
    keys = [(n, g) for _, n, g in hub.collect()]
    assert found(False) == sorted((n, g, plain.get((n, g))) for n, g in keys)
    # Two clubs of league B are "milan" without affixes, and "exact sc" could be either of two: refused.
    assert found(True) == sorted((n, g, rung.get((n, g))) for n, g in keys)


@pytest.mark.parametrize("hashed", ["well", "all alike"])
def test_uniqueness_is_exact_whatever_the_hash(spark, monkeypatch, hashed):
    if hashed == "all alike":
        monkeypatch.setattr(quality, "_hash", lambda c, kind: F.lit(7).cast("long"))
    df = spark.createDataFrame(
        [(1, "a", 0.0), (2, "a", -0.0), (3, None, None), (4, None, float("nan")), (5, "b", float("nan")), (6, "6", 6.0)], "n int, s string, x double")
    tests = [quality.DataTest("m", c, "unique", {}) for c in ("n", "s", "x")]
    assert {r.column: r.failures for r in quality.run_data_tests(tests, {"m": df}).collect()} == {"n": 0, "s": 1, "x": 2}


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
@pytest.mark.parametrize("hashed", ["well", "all alike"])
def test_hashes_met_twice_may_be_written(spark, tmp_path, monkeypatch, hashed, threshold):
    """The planner then knows that they are few: on clean data no value of a key is shuffled."""
    if hashed == "all alike":
        monkeypatch.setattr(quality, "_hash", lambda c, kind: F.lit(7).cast("long"))
    df = spark.createDataFrame(
        [(1, "a", 0.0), (2, "a", -0.0), (3, None, None), (4, None, float("nan")), (5, "b", float("nan")), (6, "6", 6.0)], "n int, s string, x double")
    kept = {}

    def keep(df, name):
        kept[name] = df.columns
        df.write.parquet(f"{tmp_path}/{name}")
        return spark.read.schema(df.schema).parquet(f"{tmp_path}/{name}")

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        tests = [quality.DataTest("m", c, "unique", {}) for c in ("n", "s", "x")]
        found = quality.run_data_tests(tests, {"m": df}, keep)
        assert {r.column: r.failures for r in found.collect()} == {"n": 0, "s": 1, "x": 2}
        assert kept == {"m__met_twice": ["i", "h"]}
        if hashed != "well":
            return
        text = found._jdf.queryExecution().executedPlan().toString()
        assert ("BroadcastHashJoin" in text) == (threshold != "-1")
        # Rows with a hash that was met twice move once: groups begin with the hash.
        assert sum("hashpartitioning(h" in x and "v#" in x for x in text.split("== Initial Plan ==")[-1].splitlines()) == (3 if threshold != "-1" else 0)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
