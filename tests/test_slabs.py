"""Slab windows equal undivided windows, with one key holding a third of the rows."""

import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridspan.operators import features as L
from gridspan.operators import grid as G
from gridspan.plans.quantiles import exact_quantiles
from gridspan.plans.slabs import (SLAB, neighbours, previous_index, running_sums, settle, slab_window,
                                  spread)
from gridspan.spec import PANEL


def panel(seed: int, hot: int = 400, cold: int = 80, keys: int = 10, p_null: float = 0.3) -> pd.DataFrame:
    rng = random.Random(seed)
    rows = []
    for k in range(keys):
        n = hot if k == 0 else cold
        for i in sorted(rng.sample(range(-50, 3 * n), n)):
            rows.append((f"k{k}", i, None if rng.random() < p_null else round(rng.uniform(-9, 9), 3)))
    return pd.DataFrame(rows, columns=["entity", "time_idx", "y"])


def frame(spark, pdf):
    return spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None).values.tolist(),
                                 "entity string, time_idx long, y double")


def rows(df):
    return sorted(map(tuple, df.collect()), key=lambda r: tuple((x is None, x) for x in r))


@pytest.mark.parametrize("size", [7, 50, 2016])
def test_neighbours(spark, size):
    df = frame(spark, panel(1))
    w = Window.partitionBy("entity").orderBy("time_idx")
    at = F.when(F.col("y").isNotNull(), F.col("time_idx"))
    want = df.select("*", F.last("y", True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("a"),
                     F.last(at, True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("b"),
                     F.first("y", True).over(w.rowsBetween(0, Window.unboundedFollowing)).alias("c"),
                     F.first(at, True).over(w.rowsBetween(0, Window.unboundedFollowing)).alias("d"))
    got = neighbours(df, ["entity"], "time_idx", ["y"], size).select(
        "entity", "time_idx", "y", "y__prev", "y__prev_at", "y__next", "y__next_at")
    assert rows(got) == rows(want)


@pytest.mark.parametrize("inclusive", [True, False])
def test_running_sums_and_previous(spark, inclusive):
    pdf = panel(2, p_null=0.0)
    df = frame(spark, pdf)
    got = running_sums(df, ["entity"], "time_idx", {"s": F.col("time_idx")}, 20, inclusive)
    want = pdf.sort_values(["entity", "time_idx"])
    cum = want.groupby("entity")["time_idx"].cumsum()
    if not inclusive:
        cum = (cum - want["time_idx"]).where(want.groupby("entity").cumcount() > 0)
    expect = {(e, i): None if pd.isna(s) else int(s) for e, i, s in zip(want.entity, want.time_idx, cum)}
    assert {(r.entity, r.time_idx): r.s for r in got.collect()} == expect
    prev = want.groupby("entity")["time_idx"].shift(1)
    expect = {(e, i): None if pd.isna(p) else int(p) for e, i, p in zip(want.entity, want.time_idx, prev)}
    seen = {(r.entity, r.time_idx): r.prev_idx for r in previous_index(df, ["entity"], "time_idx",
                                                                      size=20).collect()}
    assert seen == expect


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(back=st.integers(0, 30), ahead=st.integers(0, 30), size=st.integers(5, 60), seed=st.integers(0, 99))
def test_halo_frames(spark, back, ahead, size, seed):
    df = frame(spark, panel(seed, hot=120, cold=30, keys=4))
    w = Window.partitionBy("entity").orderBy("time_idx").rangeBetween(-back, ahead)
    want = df.withColumn("s", F.count("y").over(w))
    near = spread(df, "time_idx", back, ahead, size)
    got = settle(near.withColumn("s", F.count("y").over(
        slab_window(["entity"], "time_idx").rangeBetween(-back, ahead))), "time_idx", size)
    assert rows(got) == rows(want.select(got.columns))
    assert near.select("entity", "time_idx", SLAB).distinct().count() == near.count()


def direct(pdf, w):
    """Each window on its own: running formulas would carry the fault along."""
    means, stds = [], []
    for _, g in pdf.groupby("entity", sort=False):
        y = g["y"].to_numpy()
        for t in range(len(y)):
            x = y[max(0, t - 48 - w + 1):max(0, t - 48 + 1)]
            x = x[~np.isnan(x)]
            ok = len(x) >= max(1, w // 4)
            means.append(x.mean() if ok else np.nan)
            stds.append(x.std(ddof=1) if ok and len(x) > 1 else np.nan)
    return np.array(means), np.array(stds)


def test_lag_features_match_numpy(spark):
    rng = np.random.default_rng(5)
    parts = []
    for k, n in (("hot", 900), ("a", 500), ("b", 300)):
        y = rng.normal(50, 20, n)
        y[rng.random(n) < 0.1] = np.nan
        y[100:160] = 7.0  # constant stretch
        y[200] = 1e9  # meter fault
        parts.append(pd.DataFrame({"entity": k, "time_idx": np.arange(n), "y": y}))
    pdf = pd.concat(parts)
    df = frame(spark, pdf).withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz"))
    got = L.lag_features(df, size=200).toPandas().sort_values(["entity", "time_idx"]).reset_index(drop=True)
    pdf = pdf.sort_values(["entity", "time_idx"]).reset_index(drop=True)
    g = pdf.groupby("entity")["y"]
    for w in (24, 48, 168):
        mean, std = direct(pdf, w)
        np.testing.assert_allclose(got[f"roll_mean_{w}h"], mean, rtol=1e-9)
        np.testing.assert_allclose(got[f"roll_std_{w}h"], std, rtol=1e-9, atol=1e-9)
    np.testing.assert_allclose(got["lag_336h"], g.shift(336))
    np.testing.assert_allclose(got["diff_168h"], g.shift(48) - g.shift(216))


def test_no_row_newer_than_the_horizon_is_read(spark):
    pdf = pd.DataFrame({"entity": "a", "time_idx": range(600), "y": np.arange(600.0)})
    a = L.lag_features(frame(spark, pdf).withColumn("ts", F.lit(0)), size=100)
    pdf.loc[pdf.time_idx > 500 - 48, "y"] = 1e9
    b = L.lag_features(frame(spark, pdf).withColumn("ts", F.lit(0)), size=100)
    keep = lambda df: df.filter("time_idx <= 500").drop("y", "lag_48h")
    cols = [c for c in keep(a).columns if c.startswith(("lag", "roll", "diff"))]
    x = keep(a).filter("time_idx = 500").select(*cols).first()
    z = keep(b).filter("time_idx = 500").select(*cols).first()
    assert np.allclose(x, z, rtol=1e-6)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.integers(0, 10_000), st.sampled_from([0.05, 0.25, 0.5, 0.9]))
def test_exact_quantiles(spark, seed, p):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"k": np.where(rng.random(6000) < 0.4, "hot", rng.choice(list("abc"), 6000)),
                        "v": rng.choice([0.0, 1.0, np.nan, 1e6], 6000) + rng.integers(0, 50, 6000)})
    df = spark.createDataFrame(pdf).withColumn("v", F.nanvl("v", F.lit(None)))
    got = {r.k: (r.n, r.q) for r in exact_quantiles(df, ["k"], "v", {"q": p}, accuracy=200).collect()}
    for k, v in pdf.dropna().groupby("k")["v"]:
        assert got[k] == (len(v), pytest.approx(v.quantile(p)))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.integers(0, 1000), st.integers(4, 90))
def test_gap_operators(spark, seed, size):
    pdf = panel(seed, hot=100, cold=20, keys=3)
    df = frame(spark, pdf)
    df = df.unionByName(df.limit(5))  # copies must not count
    missing = {k: sorted(set(range(g.min(), g.max() + 1)) - set(g)) for k, g in pdf.groupby("entity").time_idx}
    got = {r.entity: r.missing_time_idx for r in G.missing_report(df, size=size).collect()}
    assert got == {k: v for k, v in missing.items() if v}
    found = {}
    for b in G.blocks(df, size=size).collect():
        found.setdefault(b.entity, []).append((b.first_idx, b.last_idx))
    for k, g in pdf.groupby("entity").time_idx:
        s = sorted(set(g))
        starts = [x for x in s if x - 1 not in set(s)]
        ends = [x for x in s if x + 1 not in set(s)]
        assert sorted(found[k]) == list(zip(starts, ends))
        tail = {r.entity: r.block_start for r in G.tail_blocks(df, size=size).collect()}
        assert tail[k] == starts[-1]


def test_grid_and_interpolation_are_idempotent(spark):
    pdf = panel(9, hot=60, cold=15, keys=3).assign(ts=lambda d: pd.Timestamp("2024-01-01")
                                                   + pd.to_timedelta(d.time_idx, "h"))
    df = spark.createDataFrame(pdf[["entity", "ts", "y"]]).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    df = df.withColumn("y", F.nanvl("y", F.lit(None)))
    once = G.interpolate(G.full_grid(df, size=20), ["y"], size=20)
    assert G.missing_counts(once).filter("missing_count > 0").count() == 0
    twice = G.interpolate(G.full_grid(once, PANEL, 33), ["y"], size=33)
    assert rows(once.select("entity", "time_idx", F.round("y", 9))) == rows(
        twice.select("entity", "time_idx", F.round("y", 9)))


def test_a_hot_key_is_spread_over_slabs(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("e"), F.col("id") % 50)).alias("entity"),
        F.floor(F.col("id") / 3).alias("time_idx"))
    near = spread(df, "time_idx", 336, 0, 1000)
    most = near.groupBy("entity", SLAB).count().agg(F.max("count")).first()[0]
    assert most <= 1336
    plan = L.lag_columns(df.withColumn("y", F.lit(1.0)), [336], size=1000)._jdf.queryExecution().toString()
    assert "hashpartitioning(entity" in plan and "_slab" in plan.split("hashpartitioning(entity")[1][:40]


def test_rank_filters_are_cut_before_the_shuffle(spark):
    from gridspan.operators import clean as K
    df = frame(spark, panel(3))
    plan = K.last_rows(df, 24, order="time_idx")._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
