"""The derived raw tables, on rows of their own with keys that repeat, are null or have no partner."""

from touchline.session import written
from workload.league import inputs


def _tables(spark, folder):
    tables = {
        "nation": ("n_nationkey bigint, n_regionkey bigint", [(0, 0), (1, 3), (2, None)]),
        "supplier": ("s_suppkey bigint, s_nationkey bigint", [(1, 0), (2, 1), (2, 0), (None, 1), (4, 2), (5, 9)]),
        "part": (
            "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
            [(1, "blue ring", "Brand#7", "SMALL", 1, 9.5), (2, "old plate", "Brand#3", "PROMO", 4, 9.0),
             (3, "hot bolt", None, "SMALL", 4, None), (3, "hot bolt", "Brand#7", None, 2, 8.0), (None, "x y", "Brand#1", "SMALL", 1, 1.0)],
        ),
        "lineitem": (
            "l_partkey bigint, l_suppkey bigint, l_shipdate string, l_quantity double, l_linenumber int",
            [(p, s, f"{y}-03-01", float(p or 1), 2) for p in (1, 2, 3, 8, None) for s in (1, 2, 4, 7, None) for y in (1995, 1996, 1996)],
        ),
    }
    for name, (schema, rows) in tables.items():
        df = spark.createDataFrame(rows, schema)
        if name == "lineitem":
            df = df.selectExpr("l_partkey", "l_suppkey", "CAST(l_shipdate AS DATE) AS l_shipdate", "l_quantity", "l_linenumber")
        df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_join_of_lines_written_once(spark, tmp_path):
    folder = _tables(spark, tmp_path)
    apart, _, _ = inputs(spark, folder)
    once, _, _ = inputs(spark, folder, join_once=True)
    for name, df in once.items():
        assert df.columns == apart[name].columns
        assert sorted(map(str, df.collect())) == sorted(map(str, apart[name].collect())) != []
    # Each raw table joined all lines again; now only the totals, which staging leaves out, have a join.
    played = {n: df.filter("not is_multi_team_total") if "fbref" in n else df for n, df in once.items()}
    for name, df in played.items():
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan, name


def test_lines_are_not_written_beside_their_join(spark, tmp_path, monkeypatch):
    from workload import league

    folder, kept = _tables(spark, tmp_path), []
    monkeypatch.setattr(league, "written", lambda df, folder, name, *more: kept.append(name) or written(df, folder, name, *more))
    inputs(spark, folder, join_once=True)
    assert sorted(kept) == ["clubs", "played"]
