import os

import pytest
from pyspark.sql import functions as F

import samples
from touchline.operators import quality
from touchline.plans.checks import DATA_TESTS
from touchline.plans.warehouse import Warehouse
from touchline.schemas import UNDERSTAT_STATS, with_metadata
from touchline.session import run_folders, shared_folder, written
from touchline.sources import raw_table
from touchline.sources.batches import BatchTable
from touchline.sources.raw_table import qualified_name, replace_season, replace_seasons
from touchline.sources.seeds import player_overrides, team_aliases


def batch(spark, season, *rows, at=samples.AT):
    df = samples.frame(
        spark, UNDERSTAT_STATS, [samples.understat_row(*r, season=season) for r in rows])
    return raw_table.stamp(df, season, "u", at)


def content(spark, table):
    df = spark.table(raw_table.qualified_name(table))
    return sorted((r._season, r.player_id, r.minutes) for r in df.collect())


def test_names():
    assert raw_table.qualified_name("raw_x__y") == "raw_x.raw_x__y"
    assert raw_table.qualified_name("y") == "default.y"


def test_replace_season(spark):
    table = "raw_sink__players"
    rows = samples.UNDERSTAT
    assert not raw_table.table_exists(spark, table)
    assert raw_table.read_raw_table(spark, table, UNDERSTAT_STATS).count() == 0

    def replace(season, *r):
        return raw_table.replace_season(spark, table, batch(spark, season, *r), UNDERSTAT_STATS, season)

    assert replace("2023-2024", *rows[:3]) == 3
    assert replace("2024-2025", *rows[:2]) == 2
    first = content(spark, table)
    assert replace("2023-2024", *rows[:3]) == 3
    assert content(spark, table) == first and len(first) == 5
    assert replace("2023-2024", rows[3]) == 1
    assert [r[:2] for r in content(spark, table)] == [
        ("2023-2024", "24"), ("2024-2025", "21"), ("2024-2025", "22")]
    assert replace("2023-2024") == 0
    assert {r[0] for r in content(spark, table)} == {"2024-2025"}
    assert replace("2022-2023") == 0
    assert raw_table.read_raw_table(spark, table, UNDERSTAT_STATS).columns == with_metadata(UNDERSTAT_STATS).names


def test_replace_goes_by_name_and_takes_its_season_only(spark):
    table = "raw_sink__by_name"
    mixed = batch(spark, "2023-2024", samples.UNDERSTAT[0]).unionByName(
        batch(spark, "2024-2025", samples.UNDERSTAT[1]))
    shuffled = mixed.select(*reversed(mixed.columns))
    assert raw_table.replace_season(spark, table, shuffled, UNDERSTAT_STATS, "2023-2024") == 1
    assert content(spark, table) == [("2023-2024", "21", 2345)]


def test_replace_seasons(spark):
    table, folder = "raw_sink__many", shared_folder(spark)
    both = batch(spark, "2023-2024", *samples.UNDERSTAT).unionByName(
        batch(spark, "2024-2025", samples.UNDERSTAT[0]))
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    assert raw_table.replace_seasons(spark, table, both, UNDERSTAT_STATS, folder) == 6
    again = batch(spark, "2024-2025", samples.UNDERSTAT[1])
    assert raw_table.replace_seasons(spark, table, again, UNDERSTAT_STATS, folder) == 1
    assert len(content(spark, table)) == 6 and content(spark, table)[-1][:2] == ("2024-2025", "22")
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_stamp(spark):
    row = batch(spark, "2023-2024", samples.UNDERSTAT[0]).first()
    assert (row._season, row._source_url, row._ingested_at.year) == ("2023-2024", "u", 2024)


def test_row_predicates(spark):
    df = spark.createDataFrame(
        [(1, 0, 5.0), (2, 4, 5.0), (3, 4, 4.0), (4, None, 1.0), (5, 2, None)], "id int, n int, x double")

    def bad(condition):
        return [r.id for r in df.filter(condition).orderBy("id").collect()]

    assert bad(quality.is_missing("n")) == [4]
    assert bad(quality.is_not_accepted("n", [0, 4])) == [5]
    assert bad(quality.is_out_of_range("x", 4, 4.5)) == [1, 2, 4]
    assert bad(quality.is_out_of_range("x", 4, inclusive=False)) == [3, 4]
    assert bad(quality.is_out_of_range("x", 4, where="n is not null")) == []
    assert bad(quality.is_ratio_above("x", "n")) == [2]
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(2,), (3,)], "p int")
    assert [tuple(r) for r in quality.duplicates(child, "k").collect()] == [(1, 2)]
    assert [r.k for r in quality.orphans(child, "k", parent, "p").collect()] == [1]
    assert [r.k for r in quality.orphan_rows(child, "k", parent, "p").collect()] == [1, 1]


@pytest.fixture(scope="module")
def tables(spark):
    w = Warehouse(samples.raw_tables(spark), team_aliases(spark), player_overrides(spark))
    return {name: w[name].cache() for name in w}


def test_good_data_passes(tables):
    results = quality.run_data_tests(DATA_TESTS, tables).collect()
    assert len(results) == 96
    assert [r for r in results if not r.passed] == []


def _spoil(df, test, tables):
    """The relation with one row that must fail the test."""
    row = df.limit(1)
    kind = dict(df.dtypes)[test.column]
    if test.kind == "not_null":
        broken = row.withColumn(test.column, F.lit(None).cast(kind))
    elif test.kind == "unique":
        broken = row
    elif test.kind == "accepted_range":
        broken = row.withColumn(test.column, F.lit(-1).cast(kind))
    elif test.kind == "xg_per_shot_range":
        broken = row.withColumn(test.column, F.lit(9.0)).withColumn(test.options["shots_column"], F.lit(2))
    else:
        broken = row.withColumn(test.column, F.lit("no such value"))
    return df.unionByName(broken)


def test_every_test_finds_a_planted_row(spark, tables):
    """Per relation: plant one bad row for each of its tests at once and look at every result."""
    for model in dict.fromkeys(t.model for t in DATA_TESTS):
        for kind in ("not_null", "unique", "accepted_values", "accepted_range", "xg_per_shot_range", "relationships"):
            chosen = [t for t in DATA_TESTS if t.model == model and t.kind == kind]
            if not chosen:
                continue
            df = tables[model]
            for t in chosen:
                df = _spoil(df, t, tables) if kind != "unique" else _spoil(tables[model], t, tables)
            spoiled = {**tables, model: df.cache()}
            found = quality.run_data_tests(chosen, spoiled).collect()
            assert [r for r in found if r.failures < 1] == [], (model, kind)
            assert quality.failing_rows(chosen[0], spoiled).count() >= 1


def test_a_failed_batch_leaves_the_season(spark):
    table = "failing__rows"
    good = batch(spark, "2023-2024", *samples.UNDERSTAT)
    assert replace_season(spark, table, good, UNDERSTAT_STATS, "2023-2024") == 5
    broken = good.withColumn("goals", F.expr("cast(raise_error('lost') as int)"))
    with pytest.raises(Exception, match="lost"):
        replace_season(spark, table, broken, UNDERSTAT_STATS, "2023-2024")
    assert spark.table(qualified_name(table)).count() == 5
    with pytest.raises(Exception, match="lost"):
        replace_seasons(spark, table, broken, UNDERSTAT_STATS)
    assert spark.table(qualified_name(table)).count() == 5
    assert replace_season(spark, table, good.limit(0), UNDERSTAT_STATS, "2023-2024") == 0
    assert spark.table(qualified_name(table)).count() == 0


def batch_folders(spark, table):
    root = raw_table._batches(spark, table).location().removeprefix("file:")
    return {name for name in os.listdir(root) if name.startswith("_batch=") and any(files for *_, files in os.walk(f"{root}/{name}"))}


@pytest.mark.parametrize("step", ["between two seasons", "at the switch"])
def test_a_batch_of_seasons_shows_as_a_whole(spark, monkeypatch, step):
    table = "failing__" + step.replace(" ", "_")
    seasons = ["2021-2022", "2022-2023", "2023-2024"]

    def of(rows):
        out = batch(spark, seasons[0], *rows)
        for season in seasons[1:]:
            out = out.unionByName(batch(spark, season, *rows))
        return out

    assert replace_seasons(spark, table, of(samples.UNDERSTAT[:2]), UNDERSTAT_STATS) == 6
    old, folders = content(spark, table), batch_folders(spark, table)

    def fail(self, *args):
        if step == "between two seasons":
            add(self, args[0], args[1][:2])
        raise RuntimeError("lost")

    add = BatchTable._add
    with monkeypatch.context() as patched:
        patched.setattr(BatchTable, "_add" if step == "between two seasons" else "_point", fail)
        with pytest.raises(RuntimeError, match="lost"):
            replace_seasons(spark, table, of(samples.UNDERSTAT[2:]), UNDERSTAT_STATS)
    assert content(spark, table) == old and batch_folders(spark, table) == folders
    assert replace_seasons(spark, table, of(samples.UNDERSTAT[2:]), UNDERSTAT_STATS) == 9
    new = content(spark, table)
    assert len(new) == 9 and not set(new) & set(old)


def test_a_reader_planned_before_a_replacement_finishes(spark):
    table = "readers__rows"
    replace_season(spark, table, batch(spark, "2023-2024", *samples.UNDERSTAT), UNDERSTAT_STATS, "2023-2024")
    planned = spark.table(qualified_name(table))
    replace_season(spark, table, batch(spark, "2023-2024", samples.UNDERSTAT[0]), UNDERSTAT_STATS, "2023-2024")
    assert planned.count() == 5 and spark.table(qualified_name(table)).count() == 1
    assert len(batch_folders(spark, table)) == 2
    # Only the files of the live batch are listed for a new reader; older ones go with the next replacement.
    (file,) = spark.table(qualified_name(table)).inputFiles()
    replace_season(spark, table, batch(spark, "2024-2025", samples.UNDERSTAT[1]), UNDERSTAT_STATS, "2024-2025")
    assert len(batch_folders(spark, table)) == 2 and len(content(spark, table)) == 2
    assert file in spark.table(qualified_name(table)).inputFiles()
    one = spark.table(qualified_name(table)).filter("_season = '2024-2025'")
    assert len(one.inputFiles()) == 1


def test_rejects_are_switched_with_their_batch(spark, monkeypatch):
    table, season = "rejects__rows", "2023-2024"

    def rejects(reason):
        rows = batch(spark, season, samples.UNDERSTAT[0])
        for name, value in (("_what", "record"), ("reject_reason", reason), ("_detail", "{}")):
            rows = rows.withColumn(name, F.lit(value))
        return rows

    def replace(n, reason):
        good = batch(spark, season, *samples.UNDERSTAT[:n])
        return replace_season(spark, table, good, UNDERSTAT_STATS, season, rejected=rejects(reason))

    def seen():
        refused = spark.table(raw_table.rejected_name(table)).select("reject_reason", "_season").collect()
        return len(content(spark, table)), [tuple(r) for r in refused]

    assert replace(3, "first") == 3 and seen() == (3, [("first", season)])
    with monkeypatch.context() as patched:
        patched.setattr(BatchTable, "_point", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            replace(2, "second")
    assert seen() == (3, [("first", season)])
    assert replace(2, "second") == 2 and seen() == (2, [("second", season)])
    assert replace(0, "third") == 0 and seen() == (0, [("third", season)])
    raw_table.drop_raw_table(spark, table)
    assert not raw_table.table_exists(spark, table) and not spark.catalog.tableExists(raw_table.rejected_name(table))


def test_seasons_of_any_name(spark):
    table, seasons = "odd__names", ["20/21", "it's", "a\\b", "ñ %41=x", "{}"]
    rows = batch(spark, seasons[0], samples.UNDERSTAT[0])
    for season in seasons[1:]:
        rows = rows.unionByName(batch(spark, season, samples.UNDERSTAT[0]))
    for _ in range(3):
        assert replace_seasons(spark, table, rows, UNDERSTAT_STATS) == 5
        assert {r[0] for r in content(spark, table)} == set(seasons)
    assert len(batch_folders(spark, table)) == 2
    with pytest.raises(ValueError, match="_season"):
        replace_seasons(spark, table, rows.withColumn("_season", F.lit(None).cast("string")), UNDERSTAT_STATS)
    assert len(content(spark, table)) == 5 and len(batch_folders(spark, table)) == 2


def test_seed_rows_may_begin_with_any_character(spark, tmp_path):
    path = tmp_path / "aliases.csv"
    path.write_text("source,source_team_name,canonical_team_name,league\n#1,a,b,c\nx,#a,,c\n")
    assert sorted(map(tuple, team_aliases(spark, str(path)).collect())) == [("#1", "a", "b", "c"), ("x", "#a", None, "c")]


def test_a_run_removes_its_folders(spark):
    taken = []
    with run_folders(spark):
        for name in "ab":
            taken.append(shared_folder(spark))
            written(spark.range(3), taken[-1], name)
        with pytest.raises(ZeroDivisionError), run_folders(spark):
            taken.append(shared_folder(spark))
            written(spark.range(3), taken[-1], "c")
            1 / 0
        assert [os.path.isdir(f.removeprefix("file:")) for f in taken] == [True, True, False]
    outside = shared_folder(spark)
    written(spark.range(3), outside, "d")
    assert not any(os.path.exists(f.removeprefix("file:")) for f in taken) and os.path.isdir(outside.removeprefix("file:"))


def test_a_warehouse_removes_what_it_wrote(spark):
    with Warehouse(samples.raw_tables(spark), team_aliases(spark), player_overrides(spark)) as w:
        assert w["stg_fbref__player_season_stats"].count() == 6
        assert list(w._ready) == [*samples.raw_tables(spark), "stg_fbref__player_season_stats"]
        assert os.path.isdir(w.folder.removeprefix("file:"))
    assert not os.path.exists(w.folder.removeprefix("file:"))
