"""The wide layout without a column per entity."""

import pytest

from gridspan.operators import stats


def test_arrays_hold_the_cells_of_the_pivot(spark):
    df = spark.createDataFrame(
        [("b", 1, 2.0, 1.0), ("a", 1, 5.0, None), ("b", 1, 3.0, 0.5), ("c", 2, -1.0, 7.0), (None, 3, 9.0, 9.0)],
        "entity string, time_idx long, y double, x double")
    rows, names = stats.wide_arrays(df, ["y", "x"])
    assert sorted(map(tuple, names.collect())) == [("a", 0), ("b", 1), ("c", 2)]
    assert sorted(map(tuple, rows.collect())) == [(1, [0, 1], [5.0, 3.0], [0.0, 1.0]), (2, [2], [-1.0], [7.0])]
    flat = {r["time_idx"]: r for r in stats.wide(df, ["a", "b", "c"], ["y", "x"]).collect()}
    for r in rows.collect():
        for code, name in enumerate("abc"):
            for c in ("y", "x"):
                cell = r[c][r["codes"].index(code)] if code in r["codes"] else 0.0
                assert flat[r["time_idx"]][f"{name}_{c}"] == cell


def test_hundred_thousand_entities(spark):
    df = spark.range(100_000).selectExpr("id AS entity", "id % 7 AS time_idx", "CAST(id AS DOUBLE) AS y")
    with pytest.raises(ValueError):
        stats.wide(df, range(100_000), ["y"])
    rows, names = stats.wide_arrays(df, ["y"])
    assert names.count() == 100_000 and len(rows.columns) == 3
    got = rows.collect()
    assert len(got) == 7 and sum(len(r["codes"]) for r in got) == 100_000
    assert all(r["codes"] == [int(v) for v in r["y"]] and r["codes"][0] == r["time_idx"] for r in got)


def test_empty_table(spark):
    rows, names = stats.wide_arrays(spark.createDataFrame([], "entity string, time_idx long, y double"), ["y"])
    assert rows.count() == 0 and names.count() == 0
