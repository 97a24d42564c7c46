import random

import pytest
from pyspark.sql import functions as F

import samples
from samples import fbref_row, understat_row, valuation_row
from touchline.functions.similarity import jaro_winkler_arrays
from touchline.operators.latest import first_per_group
from touchline.operators.skew import spread_join
from touchline.plans import checks, players, staging
from touchline.plans.warehouse import Warehouse, save_marts
from touchline.sources.batches import BatchTable
from touchline.sources.seeds import player_overrides, read_seed, team_aliases
from touchline.schemas import PLAYER_OVERRIDES, TEAM_ALIASES


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def build(spark, overrides=None, strict=False, **raw):
    return Warehouse(
        samples.raw_tables(spark, **raw), team_aliases(spark),
        overrides or player_overrides(spark), strict_parity=strict,
    )


@pytest.fixture(scope="module")
def w(spark):
    return build(spark)


def test_staging(w):
    assert w["stg_fbref__player_season_stats"].count() == 6
    assert w["stg_understat__player_season_stats"].count() == 4
    assert w["stg_transfermarkt__player_valuations"].count() == 5
    assert [r[0] for r in rows(w["stg_fbref__player_season_stats"], "age_years")] == [18, 22, 26, 27, 27, 29]
    assert [r[0] for r in rows(w["stg_understat__player_season_stats"], "position_group")] == [
        "Defender", "Forward", "Forward", "Midfielder"]
    striker = w["stg_fbref__player_season_stats"].filter("fbref_player_id = '0f1e2d3c'").first()
    assert striker.player_season_team_id == "85d8fa319adc3ea7b1c8a1912d10aac2"


def test_team_xref(w):
    assert rows(w["int_team_xref"], "canonical_team_name", "understat_team_name", "transfermarkt_team_id") == [
        ("eastham city", "eastham city", "310"), ("lagoa", None, None), ("northbridge", "northbridge", None),
        ("vila nova", None, None), ("westmoor", "westmoor", None),
    ]


def test_player_xref(w):
    top = 0.9999999999999999
    got = rows(w["int_player_xref"], "fbref_player_id", "understat_player_id", "transfermarkt_player_id",
               "confidence", "transfermarkt_confidence", "match_status")
    assert got == [
        ("0a1b2c3d", "21", None, top, None, "auto_matched"),
        ("0f1e2d3c", "22", "700100", top, top, "auto_matched"),
        ("4b5a6978", None, None, None, None, "unmatched"),
        ("99887766", None, None, None, None, "unmatched"),
        ("a0b0c0d0", None, None, None, None, "unmatched"),
    ]


def test_dimensions(w):
    assert [w[d].count() for d in ("dim_team", "dim_player", "dim_season", "dim_competition")] == [5, 5, 3, 5]
    city = w["dim_team"].filter("fbref_team_id = '33cc44dd'").first()
    assert (city.team_key, city.transfermarkt_team_id) == ("99be958ff40ed9356c583e2af49bce63", "310")
    twice = w["dim_player"].filter("fbref_player_id = '99887766'").first()
    assert (twice.full_name, twice.short_name, twice.age_years) == ("Rúben Soárez", "ruben soarez", 27)


def test_facts(w):
    stats = w["fct_player_season_stats"]
    total = stats.agg(F.count("*"), F.sum("minutes"), F.sum("goals")).first()
    assert tuple(total) == (6, 7409, 48)
    sources = {tuple(r[0]): r[1] for r in stats.groupBy("_sources").count().collect()}
    assert sources == {("fbref", "understat"): 2, ("fbref",): 4}
    one = w["fct_player_season_valuations"].collect()
    assert len(one) == 1
    assert (one[0].valuation_key, one[0].market_value_eur, one[0].nationality, str(one[0].date_of_birth)) == (
        "ab8c6a4850d9226bbe6156c81e9acaf1", 95_000_000, "Sweden", "2001-02-03")
    assert stats.filter("player_season_stats_key = 'ab8c6a4850d9226bbe6156c81e9acaf1'").count() == 1


def test_strict_parity_leaves_written_birth_dates_out(spark):
    one = build(spark, strict=True)["fct_player_season_valuations"].first()
    assert one.date_of_birth is None


def test_checks(spark, w):
    got = {r["check"]: r for r in checks.run_checks(w).collect()}
    assert got["player_xref_match_rate"].metadata == {"matched": "2", "total": "5", "match_rate": "0.4"}
    assert not got["player_xref_match_rate"].passed and got["mart_row_counts"].passed
    assert len(checks.enforce(checks.run_checks(w))) == 5
    with pytest.raises(checks.CheckFailed, match="raw_fbref"):
        checks.enforce(checks.run_checks({}))
    empty = build(spark, fbref=[], understat=[], valuations=[])
    rate = checks.match_rate(empty["int_player_xref"], empty["stg_fbref__player_season_stats"]).first()
    assert (rate.total, rate.match_rate, rate.passed) == (0, None, False)


def test_save_marts(spark, w):
    save_marts(w, "marts")
    assert spark.table("marts.fct_player_season_stats").count() == 6


def test_marts_of_one_season(spark, w, monkeypatch):
    """One season is computed and written again; a build that fails leaves the tables as they were."""
    save_marts(w, "season_marts")
    name = "season_marts.fct_player_season_stats"
    facts = BatchTable(spark, name, "season_key")
    before, live = rows(spark.table(name), "*"), facts.live()
    labels = {r.season_label: r.season_key for r in w["dim_season"].collect()}
    assert before == rows(w["fct_player_season_stats"], "*") and set(live) <= set(labels.values())
    other = build(spark, fbref=[fbref_row(*samples.FBREF[0])])
    with monkeypatch.context() as patched:
        patched.setattr(BatchTable, "_point", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            save_marts(other, "season_marts")
    assert rows(spark.table(name), "*") == before and facts.live() == live
    assert spark.table("season_marts.dim_player").count() == w["dim_player"].count()
    save_marts(w, "season_marts", [samples.SEASON])
    again = facts.live()
    assert {k for k in live if live[k] != again[k]} == {labels[samples.SEASON]} and rows(spark.table(name), "*") == before
    save_marts(other, "season_marts", ["2024-2025"])  # has no rows there
    assert rows(spark.table(name), "*") == [r for r in before if labels["2024-2025"] not in r]


def test_seeds(spark, tmp_path):
    assert team_aliases(spark).count() == 54 and player_overrides(spark).count() == 0
    path = tmp_path / "o.csv"
    path.write_text(",".join(PLAYER_OVERRIDES.names) + "\n")
    assert player_overrides(spark, str(path)).count() == 0
    path.write_text("source,source_team_name,canonical_team_name,league\nfbref,\"a, b\",c,L\n")
    assert read_seed(spark, str(path), TEAM_ALIASES).collect()[0][:] == ("fbref", "a, b", "c", "L")


FB = ("p1", "Ann Lee", "FW", "Arsenal", "t1", "20-001", 1, 90, 1, 0, 0.5)
US = ("u1", "Ann Lee", "Arsenal", "F S", 1, 90, 1, 0.5, 0.1, 0.5, 1.0, 0.5, 3, 1)
TM = ("m1", "Ann Lee", "Arsenal", "9", "Left Winger", "Jan 1, 2000", 24, "Peru", "€1.00m", 1_000_000)


def small(spark, fbref, understat, valuations=(), overrides=None):
    return build(spark, overrides, fbref=fbref, understat=list(understat), valuations=list(valuations))


def test_ties_go_to_the_least_id_and_club(spark):
    w = small(
        spark,
        [fbref_row(*FB), fbref_row(*FB, team_id="t0", team_name="Chelsea")],
        [understat_row(*US, player_id=i, team_name="Chelsea") for i in ("u9", "u2", "u3")],
    )
    assert rows(w["int_player_xref"], "understat_player_id", "match_status") == [("u2", "auto_matched")]


def test_missing_values(spark):
    w = small(
        spark,
        [fbref_row(*FB, minutes=None), fbref_row(*FB, player_id="p2", player_name="Pelé", position=None),
         fbref_row(*FB, player_id="p3", player_name="")],
        [understat_row(*US, minutes=None), understat_row(*US, player_id="u2", player_name="Pele"),
         understat_row(*US, player_id="u3", player_name=""), understat_row(*US, player_id="u4", player_name="X Lee", minutes=0)],
    )
    assert rows(w["int_player_xref"], "fbref_player_id", "understat_player_id", "confidence") == [
        ("p1", "u1", 0.9999999999999999), ("p2", "u2", 0.95), ("p3", None, None)]


def test_overrides(spark):
    manual = samples.overrides(
        spark, dict(fbref_player_id="p1", understat_player_id="u7", canonical_player_id="c1"))
    w = small(
        spark, [fbref_row(*FB), fbref_row(*FB, season="2024-2025")], [understat_row(*US)], [valuation_row(*TM)], manual)
    assert rows(w["int_player_xref"], "canonical_player_id", "understat_player_id", "season", "match_status") == [
        ("c1", "u7", "2023-2024", "manual_override"), ("c1", "u7", "2024-2025", "manual_override")]
    # The statistics fact looks for the source id, the valuation fact for the canonical one.
    assert w["fct_player_season_stats"].count() == 0
    assert w["fct_player_season_valuations"].count() == 1
    twice = samples.overrides(spark, dict(fbref_player_id="a"), dict(fbref_player_id="a"), dict(fbref_player_id="b"))
    assert rows(players.check_overrides(twice), "fbref_player_id") == [("a",)]


def test_one_candidate_may_serve_two_players_and_two_rows_multiply(spark):
    w = small(
        spark,
        [fbref_row(*FB), fbref_row(*FB, player_id="p2"),
         fbref_row(*FB, player_id="p2", team_id="t2", team_name="Chelsea", minutes=10)],
        [understat_row(*US), understat_row(*US, team_name="Chelsea", minutes=5)],
    )
    assert rows(w["int_player_xref"], "fbref_player_id", "understat_player_id") == [("p1", "u1"), ("p2", "u1")]
    assert w["fct_player_season_stats"].count() == 6


def test_large_values_and_last_ingest(spark):
    raw = samples.raw_tables(spark, valuations=[valuation_row(*TM, market_value_eur=3_000_000_000)])
    name = "raw_transfermarkt__player_valuations"
    later = raw[name].withColumn("_ingested_at", F.col("_ingested_at") + F.expr("interval 1 hour"))
    raw[name] = raw[name].withColumn("market_value_eur", F.lit(5).cast("bigint")).unionByName(later)
    w = Warehouse(raw, team_aliases(spark), player_overrides(spark))
    assert rows(w["stg_transfermarkt__player_valuations"], "market_value_eur") == [(3_000_000_000,)]


def test_alias_of_one_source_only(spark):
    w = small(
        spark, [fbref_row(*FB, team_name="Wolves")],
        [understat_row(*US, team_name="Wolverhampton Wanderers")], [valuation_row(*TM, team_name="Wolves FC")])
    assert rows(w["int_team_xref"], "canonical_team_name", "understat_team_name", "transfermarkt_team_id") == [
        ("wolverhampton wanderers", "wolverhampton wanderers", None)]


def _crowd(rng, n):
    """Names that share a last name at one club: one hot block."""
    firsts = ["Ann", "Anne", "Anna", "Hanna", "Bo", "Bob", "Rob", "Robert", "Roberta", "Ana Bea", "Bea Ana"]
    return [f"{rng.choice(firsts)} {rng.choice('abc')} Lee" for _ in range(n)]


def test_matching_agrees_with_all_pairs_in_a_hot_block(spark):
    rng = random.Random(3)
    fb = [fbref_row(*FB, player_id=f"p{i:02d}", player_name=n, position=rng.choice(["FW", "MF", None]),
                    minutes=10 + i)
          for i, n in enumerate(_crowd(rng, 60))]
    us = [understat_row(*US, player_id=f"u{i:02d}", player_name=n, position=rng.choice(["F", "M", None]),
                        minutes=10 + i)
          for i, n in enumerate(_crowd(rng, 50))]
    w = small(spark, fb, us)
    stg_f, stg_u, stg_t = w.staged()
    groups = {"F": "Forward", "M": "Midfielder", None: None}
    codes = {"FW": "Forward", "MF": "Midfielder"}
    expected = []
    for f in fb:
        best = None
        for u in us:
            name = jaro_winkler_arrays([f["player_name"].lower().encode()], [u["player_name"].lower().encode()])[0]
            group = groups[u["position"]]
            pos = 0.5 if f["position"] is None or group is None else float(codes[f["position"]] == group)
            score = 0.6 * name + 0.3 * 1.0 + 0.1 * pos
            if score >= 0.75 and (best is None or (-score, u["player_id"]) < best):
                best = (-score, u["player_id"])
        expected.append((f["player_id"], best and best[1], best and -best[0]))
    for cell in (10_000_000, 7):
        xref = players.resolve_players(stg_f, stg_u, stg_t, w["int_team_xref"], w.overrides, pairs_per_cell=cell)
        assert rows(xref, "fbref_player_id", "understat_player_id", "confidence") == expected


@pytest.mark.parametrize("cell", [1, 10, 10_000])
def test_spread_join_gives_each_pair_once(spark, cell):
    rng = random.Random(cell)
    left = [(rng.choice([1, 1, 1, 2, 3]), i) for i in range(80)]
    right = [(rng.choice([1, 1, 1, 3, 4]), i) for i in range(70)]
    got = spread_join(
        spark.createDataFrame(left, "k int, a int"), spark.createDataFrame(right, "k int, b int"), ["k"], cell)
    expected = sorted((k, a, b) for k, a in left for k2, b in right if k == k2)
    assert sorted((r.k, r.a, r.b) for r in got.collect()) == expected


def test_group_limit_on_both_sides_of_the_exchange(spark):
    df = first_per_group(spark.range(100).withColumn("g", F.col("id") % 3), ["g"], [F.col("id").desc()])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert rows(df, "id") == [(97,), (98,), (99,)]


def test_order_and_partitions_do_not_matter(spark):
    rng = random.Random(5)
    fb = [fbref_row(*FB, player_id=f"p{i % 9}", player_name=n, team_id=f"t{i % 3}",
                    team_name=["Arsenal", "Chelsea", "Everton"][i % 3], minutes=rng.choice([None, 90, 90]))
          for i, n in enumerate(_crowd(rng, 27))]
    us = [understat_row(*US, player_id=f"u{i % 7}", player_name=n, team_name=["Arsenal", "Chelsea"][i % 2],
                        minutes=rng.choice([None, 90, 90]))
          for i, n in enumerate(_crowd(rng, 14))]
    tm = [valuation_row(*TM, player_id=f"m{i % 5}", player_name=n, market_value_eur=rng.choice([1, 1, None]))
          for i, n in enumerate(_crowd(rng, 10))]
    seen = []
    fb += [r | {"nationality": "fr FRA"} for r in fb]
    tm += [r | {"market_value_eur": 2, "nationality": "Chile"} for r in tm]
    for parts in (1, 7):
        rng.shuffle(fb)
        rng.shuffle(us)
        rng.shuffle(tm)
        raw = {n: df.repartition(parts) for n, df in samples.raw_tables(spark, fb, us, tm).items()}
        w = Warehouse(raw, team_aliases(spark), player_overrides(spark))
        seen.append([rows(w[n], *[c for c in w[n].columns]) for n in (
            "stg_transfermarkt__player_valuations", "int_player_xref", "dim_player", "dim_team")])
    assert seen[0] == seen[1]


def test_fact_rows_move_at_most_twice(spark):
    """Without broadcasts: once for the clubs and once for the players."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        w = build(spark)
        for fact, column in ((w["fct_player_season_stats"], "penalties_attempted"), (w["fct_player_season_valuations"], "date_of_birth")):
            text = fact._jdf.queryExecution().executedPlan().toString()
            # The branch of the fact is the one that reads the measure.
            assert _exchanges_above(text, column) <= 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _exchanges_above(plan, column):
    """Shuffles between the root and the scan that reads a column."""
    lines = plan.splitlines()
    scan = next(i for i, x in enumerate(lines) if "FileScan" in x and column in x)
    depth = len(lines[scan]) - len(lines[scan].lstrip(" :+-"))
    count = 0
    for x in reversed(lines[:scan]):
        here = len(x) - len(x.lstrip(" :+-"))
        if here < depth:
            depth = here
            count += "Exchange" in x and "Broadcast" not in x
    return count


def test_only_read_columns_of_staging_are_written(spark):
    """Cross-references and facts do not write the wide staging relations; asked for by name, these are whole."""
    w = build(spark)
    kept = []
    w.keep = lambda df, name: kept.append((name, df.columns)) or Warehouse.keep(w, df, name)
    assert w["int_player_xref"].count() and w["dim_player"].count()
    columns = {name: c for name, c in kept if name.startswith("stg_")}
    assert len(columns) == 3 and all(len(c) <= 12 for c in columns.values())
    facts = {n: w[n] for n in ("fct_player_season_valuations", "fct_player_season_stats")}
    columns = {name: c for name, c in kept if name.startswith("stg_")}
    assert len(columns) == 5
    assert not any("player_season_team_id" in c or "_source_url" in c for c in columns.values())
    whole = build(spark)
    assert len(whole["stg_fbref__player_season_stats"].columns) > 30
    assert "player_valuation_id" in whole["stg_transfermarkt__player_valuations"].columns
    whole["stg_understat__player_season_stats"]
    for name, fact in facts.items():
        assert fact.exceptAll(whole[name]).isEmpty() and whole[name].exceptAll(fact).isEmpty()
    assert [df.columns for df in whole.staged()] == [whole[n].columns for n in (
        "stg_fbref__player_season_stats", "stg_understat__player_season_stats", "stg_transfermarkt__player_valuations")]


def test_written_files_and_scans_are_bounded(spark, tmp_path):
    """What a task reads does not grow with the table: files hold a number of rows, and scans are dealt in small pieces."""
    from touchline import session

    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        out = session.written(spark.range(1050).coalesce(1), str(tmp_path), "ids", 100)
        assert len(list((tmp_path / "ids").glob("*.parquet"))) == 11 and out.distinct().count() == 1050
        session.small_scans(spark)
        assert int(spark.conf.get("spark.sql.files.maxPartitionBytes")) == 16 * 1024 * 1024
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_staging_is_written_for_those_who_read_it(spark):
    """F3, F6, F10-F16: a warehouse that is asked for matches alone writes no birth dates, raw names or measures; the cross-reference
    of teams writes no staging at all; and rows are the same whatever was read before."""
    whole, kept = build(spark), []
    narrow = Warehouse(samples.raw_tables(spark), team_aliases(spark), player_overrides(spark), reads=[])
    narrow.keep = lambda df, name: kept.append((name, df.columns)) or Warehouse.keep(narrow, df, name)
    xref = narrow["int_team_xref"]
    assert [name for name, _ in kept] == ["int_team_xref"]
    assert xref.exceptAll(whole["int_team_xref"]).isEmpty() and whole["int_team_xref"].exceptAll(xref).isEmpty()
    narrow["int_player_xref"]
    written = {c for name, columns in kept if name.startswith("stg_") for c in columns}
    assert not written & {"date_of_birth", "nationality", "player_name_raw", "age_years", "xg"}
    for name in ("int_player_xref", "dim_player", "dim_team", "fct_player_season_valuations", "fct_player_season_stats"):
        assert narrow[name].columns == whole[name].columns
        assert narrow[name].exceptAll(whole[name]).isEmpty() and whole[name].exceptAll(narrow[name]).isEmpty()


def test_clubs_are_those_of_staging(spark, w):
    """A club that only never-played rows or an older batch name is in neither."""
    fresh = Warehouse(samples.raw_tables(spark), team_aliases(spark), player_overrides(spark))
    for clubs, name in zip(fresh.clubs(), (n for n in fresh if n.startswith("stg_"))):
        staged = w[name].select(*clubs.columns)
        assert set(map(tuple, clubs.collect())) == set(map(tuple, staged.collect()))


def test_facts_are_counted_without_measures(spark, w):
    for name, column in (("fct_player_season_stats", "player_season_stats_key"), ("fct_player_season_valuations", "valuation_key")):
        fresh = Warehouse(samples.raw_tables(spark), team_aliases(spark), player_overrides(spark), reads=["dimensions"])
        bare = fresh.fact_without_measures(name)
        assert bare.columns == w[name].columns and rows(bare, column) == rows(w[name], column)


def test_the_key_of_the_fact_is_worked_out_below_the_enrichment(spark, w):
    text = w["fct_player_season_stats"]._jdf.queryExecution().optimizedPlan().toString()
    lines = text.splitlines()
    key = next(i for i, x in enumerate(lines) if "md5(" in x)
    assert key > next(i for i, x in enumerate(lines) if "Join LeftOuter" in x)


def test_a_warehouse_leaves_little_on_disk(spark, tmp_path):
    """Shuffle files go with their query, steps of the matching with its result, and relations are written with zstd."""
    spark.conf.unset("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    w = Warehouse(samples.raw_tables(spark), team_aliases(spark), player_overrides(spark), folder=str(tmp_path))
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"
    steps = []
    w.keep = lambda df, name: steps.append(name) or Warehouse.keep(w, df, name)
    xref = w["int_player_xref"]
    assert {"matching/main_fbref_rows", "matching/understat_names"} <= set(steps)
    there = {p.name for p in tmp_path.iterdir()}
    assert "int_player_xref" in there and not there & {"matching", "main_fbref_rows", "understat_names", "understat_profiles"}
    files = list(tmp_path.rglob("*.parquet"))
    assert files and all(".zstd." in f.name for f in files)
    # A relation that is executed twice shuffles again, with the same rows.
    counted = xref.groupBy("match_status").count()
    assert sorted(map(str, counted.collect())) == sorted(map(str, counted.collect())) != []


def test_keys_of_staging_are_not_written(spark, w):
    """A surrogate key does not compress. Readers of some columns get it worked out from the columns that it is made of."""
    kept = {}
    narrow = Warehouse(samples.raw_tables(spark), team_aliases(spark), player_overrides(spark), reads=["data_tests"])
    narrow.keep = lambda df, name: kept.update({name: df.columns}) or Warehouse.keep(narrow, df, name)
    for _ in range(2):
        staged = narrow.staged()
        assert len(kept) == 3 and not {"player_season_team_id", "player_valuation_id"} & {c for cs in kept.values() for c in cs}
    for df, name in zip(staged, staging.KEYS):
        assert staging.KEYS[name][0] in df.columns
        assert df.exceptAll(w[name].select(*df.columns)).isEmpty() and w[name].select(*df.columns).exceptAll(df).isEmpty()
    # One more reader: its columns are added to those that were there.
    more = narrow.staged("dimensions", "fct_player_season_stats", "fct_player_season_valuations")
    for df, old in zip(more, staged):
        assert set(old.columns) <= set(df.columns)
    assert "player_season_team_id" in more[0].columns and "date_of_birth" in more[2].columns


def test_valuations_move_by_player(spark):
    """Rows of a player lie together, so what a task picks per player and season later is one row and not one per club."""
    tm = [valuation_row(*TM, player_id=f"m{i % 3}", team_id=f"t{i % 4}", team_name=f"club {i % 4}", market_value_eur=i) for i in range(40)]
    raw = samples.raw_tables(spark, [], [], tm)["raw_transfermarkt__player_valuations"].repartition(5)
    staged = staging.stage_transfermarkt(raw)
    found = staged.withColumn("task", F.spark_partition_id())
    assert found.count() == 12
    assert found.groupBy("transfermarkt_player_id").agg(F.countDistinct("task").alias("n")).filter("n > 1").isEmpty()
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = staged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    moves = [x for x in text.splitlines() if "Exchange hashpartitioning" in x]
    assert len(moves) == 1 and "team_id" not in moves[0]


def test_keys_of_constants_are_added_after_the_shuffles(spark):
    """A season's and a league's key would move with each row of a fact, and a club's key as text."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        w = build(spark)
        for fact in (w["fct_player_season_stats"], w["fct_player_season_valuations"]):
            lines = fact._jdf.queryExecution().optimizedPlan().toString().splitlines()
            depth = [len(x) - len(x.lstrip(" :+-")) for x in lines]
            packed = next(i for i, x in enumerate(lines) if "unhex(" in x)
            below = [x for i, x in enumerate(lines) if i > packed and all(d > depth[packed] for d in depth[packed + 1:i + 1])]
            assert sum("LeftSemi" in x for x in below) == 2
            assert not any("season_key#" in x or "competition_key#" in x for x in below)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_profile_with_several_links_is_settled_once(spark):
    hub = spark.createDataFrame(
        [("f1", "2023-2024", "L", "t", "MF", "john smith", 9, "MF")],
        "fbref_player_id string, season string, league string, fbref_team_id string, position string, hub_name string, minutes int, position_mark string")
    other = spark.createDataFrame(
        [(f"u{i}", "2023-2024", "L", "john smith", team, "Midfielder", 9) for i, team in enumerate(["b", "a", "a", "c"])],
        "other_id string, season string, league string, other_name string, other_team string, other_position string, minutes int")
    xref = spark.createDataFrame([("t", "a"), ("t", "b")], "fbref_team_id string, understat_team_name string")
    found = players.best_matches(hub, other, xref, players.UNDERSTAT)
    assert rows(found, "hub_name", "other_id", "composite_score") == [("john smith", "u0", 0.9999999999999999)]
    text = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    # Nothing is made distinct above the join with the settled names.
    assert not any("Aggregate" in x for x in text[:next(i for i, x in enumerate(text) if "Join" in x)])
