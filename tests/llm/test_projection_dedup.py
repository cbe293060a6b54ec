import math

import numpy as np
import pytest
from pyspark.sql import types as T

from gridspan.llm import projection_dedup as pd_

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                       T.StructField("label", T.IntegerType()), T.StructField("ball", T.StringType()),
                       T.StructField("point", T.StringType()), T.StructField("unit", T.StringType()),
                       T.StructField("row", T.StringType())])


def table(spark, rows):
    return spark.createDataFrame([(i, None if e is None else [None if v is None else float(v) for v in e], g, "a", "b", "c", "d")
                                  for i, e, g in rows], SCHEMA)


def plain(rows, limit=0.93):
    """(vec_id, n_links, component_id) by comparing all pairs."""
    def fit(e, g):
        return g is not None and bool(e) and all(v is not None and math.isfinite(v) for v in e) and any(e)

    def unit(e):
        x = np.array(e, float)
        x = x / np.abs(x).max()
        return x / np.sqrt((x * x).sum())
    rows = [(i, None if e is None else list(e), g) for i, e, g in rows]
    units = [unit(e) if fit(e, g) else None for _, e, g in rows]
    near = [[j for j, (_, e, h) in enumerate(rows) if j != i and units[i] is not None and units[j] is not None and g == h
             and len(units[i]) == len(units[j]) and units[i] @ units[j] >= limit] for i, (_, _, g) in enumerate(rows)]
    out = []
    for i, row in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((row[0], len(near[i]), min(ids, default=None)))
    return sorted(out, key=str)


def found(df):
    rows = df.collect()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in rows)
    return sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in rows), key=str)


def turned(x, cosine, rng):
    """A unit vector at exactly this cosine to ``x``."""
    y = rng.normal(size=len(x))
    y -= (y @ x) * x
    return cosine * x + math.sqrt(1 - cosine ** 2) * y / np.linalg.norm(y)


def test_dense_groups_chains_and_labels(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=64), i % 2) for i in range(60)]
    middle = rows[0][1] / np.linalg.norm(rows[0][1])
    # A third of all rows in one dense group, one wider group, and a chain.
    rows += [(100 + i, middle + rng.normal(size=64) * 0.01, 0) for i in range(60)]
    rows += [(200 + i, rows[1][1] + rng.normal(size=64) * 0.1, 1) for i in range(30)]
    step = rows[2][1] / np.linalg.norm(rows[2][1])
    for i in range(6):
        step = turned(step, 0.97, rng)
        rows.append((300 + i, step * 3, 0))
    rows += [(400, rows[61][1], 1), (401, rows[61][1], None)]
    got, want = found(pd_.near_vectors(table(spark, rows))), plain(rows)
    assert got == want
    assert max(n for _, n, _ in want) >= 60 and sum(n > 0 for _, n, _ in want) > 90


def test_recall_at_the_threshold(spark):
    rng = np.random.default_rng(6)
    rows = []
    for i in range(400):
        x = rng.normal(size=64)
        x /= np.linalg.norm(x)
        rows += [(2 * i, x, 1), (2 * i + 1, turned(x, 0.9301, rng), 1)]
    rows += [(1000, rows[0][1], 1), (1001, turned(rows[0][1], 0.9299, rng), 1)]
    got = {r[0]: r[1] for r in found(pd_.near_vectors(table(spark, rows)))}
    assert sum(got[2 * i] > 0 for i in range(400)) >= 0.96 * 400
    assert got[1001] == 0


def test_odd_vectors(spark):
    e = [1.0, 2.0, 3.0]
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0, 0.0], 1), (4, [1.0, None, 3.0], 1), (5, [1.0, math.nan, 3.0], 1),
            (6, [math.inf, 0.0, 0.0], 1), (7, e, 1), (7, e, 1), (8, e, None), (9, [1e300, 2e300, 3e300], 1),
            (10, [1e-300, 2e-300, 3e-300], 1), (11, [1.0, 2.0], 1), (12, [2.0, 4.0], 1), (None, [4.0, 2.0, -9.0], 1),
            (13, [4.0, 2.0, -9.0], 1), (None, [-5.0, 0.0, 0.0], 2), (14, [-0.0, 5.0, 0.0], 3), (15, [0.0, 5.0, 0.0], 3)]
    got = pd_.near_vectors(table(spark, rows)).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=str) == plain(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got if r["component_id"] is not None)


def test_empty_table(spark):
    assert pd_.near_vectors(table(spark, [])).count() == 0


@pytest.mark.parametrize("cosine", [0.8, 0.93, 0.99])
def test_calibration_agrees_with_trials(cosine):
    plan = pd_.calibrated(cosine, 1000)
    rng = np.random.default_rng(7)
    pairs = [(x := v / np.linalg.norm(v), turned(x, cosine, rng)) for v in rng.normal(size=(400, 32))]
    a, b = (np.stack(s) for s in zip(*pairs))
    hits = np.zeros(400, int)
    for table_ in range(plan.tables):
        (cell, at), (other, there) = plan.places(a, table_), plan.places(b, table_)
        hits += (cell == other) & (np.abs(at - there) <= plan.window)
    assert (hits >= plan.count).mean() >= 0.97
    assert pd_.calibrated(cosine, 10 ** 8).deep >= plan.deep and pd_.calibrated(0.93, 10 ** 8).deep > 10
