"""Rolling evaluation, recursion and window samples against plain Python."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridspan.operators import features as L
from gridspan.operators import forecast as H
from gridspan.operators import rolling as O
from gridspan.plans import slabs as S
from gridspan.spec import PANEL

START = dt.datetime(2024, 1, 1)


def panel(spark, series, first=0):
    """entity -> values, one a step; NULL where None."""
    rows = [(e, START + dt.timedelta(hours=first + i), first + i, v, float(i % 24), f"kind {e}")
            for e, values in series.items() for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "entity string, ts timestamp_ntz, time_idx long, y double, hour double, kind string")


SERIES = {"a": [float((i * 7) % 31) if i % 11 else None for i in range(205)], "b": [float(i % 13) for i in range(97)],
          "c": [1.0] * 30}
SPEC = PANEL.with_(known_future=("hour",), past_only=("hour",), static=("kind",), horizon=24)


@pytest.mark.parametrize("size", [17, 50, 1000])
def test_origins_see_their_own_past_only(spark, size):
    got = O.origin_windows(panel(spark, SERIES), 30, 48, spec=SPEC, size=size).collect()
    want = {(e, o) for e, v in SERIES.items() for o in range(47, len(v) - 1, 24)}
    assert {(r.entity, r.origin_idx) for r in got} == want and len(got) == len(want)
    for r in got:
        v, o = SERIES[r.entity], r.origin_idx
        assert r.context == v[o - 29:o + 1] and r.kind == f"kind {r.entity}"
        assert r.ahead == min(24, len(v) - 1 - o)
        assert r.target == (v[o + 1:o + 25] + [None] * 24)[:24]
        assert r.target_ts[0] == START + dt.timedelta(hours=o + 1)
        assert r.ahead_hour[:r.ahead] == [float((o + 1 + k) % 24) for k in range(r.ahead)] and r.past_hour[-1] == o % 24


def test_context_before_the_series_is_unknown(spark):
    got = O.origin_windows(panel(spark, {"b": SERIES["b"]}, first=100), 10, 104, 48, PANEL, 64).collect()
    first = min(got, key=lambda r: r.origin_idx)
    assert first.origin_idx == 103 and first.context == [None] * 6 + SERIES["b"][:4]


def test_scorers_agree_and_pad_the_last_tile(spark):
    df, lags = panel(spark, SERIES), (24, 30)
    weights = {"lag_24h": 0.5, "lag_30h": 0.25}

    def batch(contexts, covariates):
        assert covariates["ahead_hour"].shape == (len(contexts), 24)
        a, b = contexts[:, -24:], np.concatenate([contexts[:, -30:], contexts[:, :0]], 1)[:, :24]
        return np.maximum(0, 1.0 + 0.5 * a + 0.25 * b)

    runs = [O.rolling_evaluation(df, scorer, 30, 48, spec=SPEC, size=40).collect() for scorer in (
        O.linear_origins(weights, 1.0, lags, SPEC), O.batch_origins(batch, spec=SPEC),
        O.model_origins(lambda r: r.withColumn("pred", F.greatest(F.lit(0.0), 1.0 + 0.5 * F.col("lag_24h")
                                                                  + 0.25 * F.col("lag_30h"))), lags, SPEC))]
    plain = {}
    for e, v in SERIES.items():
        for o in range(47, len(v) - 1, 24):
            for k in range(1, min(24, len(v) - 1 - o) + 1):
                a, b = v[o + k - 24], v[o + k - 30]
                plain[e, o + k] = None if a is None or b is None else 1.0 + 0.5 * a + 0.25 * b
    for rows in runs:
        assert len(rows) == len(plain)
        for r in rows:
            assert r.time_idx == r.origin_idx + r.lead and r.y == SERIES[r.entity][r.time_idx]
            want = plain[r.entity, r.time_idx]
            if want is not None:
                assert r.pred == pytest.approx(want)


def test_fit_recovers_a_plane_and_refuses_no_rows(spark):
    df = spark.range(200).select(F.col("id").cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"))
    df = df.withColumn("y", 3 * F.col("a") - 2 * F.col("b") + 5).unionByName(
        spark.createDataFrame([(None, 1.0, 2.0)], "a double, b double, y double"))
    weights, intercept = O.fit_linear(df, ["a", "b"], "y")
    assert weights == pytest.approx({"a": 3, "b": -2}) and intercept == pytest.approx(5)
    with pytest.raises(ValueError):
        O.fit_linear(df.filter("a < 0"), ["a", "b"], "y")


@pytest.mark.parametrize("chunk", [5, 16])
def test_recursion_over_all_steps_equals_a_loop(spark, chunk):
    df = panel(spark, {"a": [float((i * 7) % 31) for i in range(120)], "b": [float(i % 13) for i in range(90)]})
    past, future = df.filter("time_idx < 40"), df.filter("time_idx >= 40").select("entity", "ts", "time_idx")
    scorer = H.linear_scorer({"lag_16h": 0.9, "lag_30h": 0.2}, 0.5, lags=(16, 30), windows=(), diffs=(), size=64)
    got = H.recursive_forecast(past, future, scorer, None, 30, chunk=chunk).collect()
    want = {}
    for e, n in (("a", 120), ("b", 90)):
        v = [float((i * 7) % 31) if e == "a" else float(i % 13) for i in range(40)]
        for i in range(40, n):
            v.append(0.5 + 0.9 * v[i - 16] + 0.2 * v[i - 30])
            want[e, i] = v[i]
    assert {(r.entity, r.time_idx): r.pred for r in got} == pytest.approx(want) and len(got) == len(want)


def test_the_plan_of_a_chunk_does_not_grow(spark, monkeypatch):
    sizes = []
    real = H.staged
    monkeypatch.setattr(H, "staged", lambda df, label, partition=None: (
        sizes.append(len(df._jdf.queryExecution().optimizedPlan().toString())) if "_scored" in df.columns else None,
        real(df, label, partition))[1])
    df = panel(spark, {"a": [float(i % 31) for i in range(80)]})
    scorer = H.linear_scorer({"lag_4h": 1.0}, lags=(4,), windows=(), diffs=(), size=64)
    future = df.filter("time_idx >= 16").select("entity", "ts", "time_idx")
    H.recursive_forecast(df.filter("time_idx < 16"), future, scorer, None, 8, chunk=4).collect()
    assert len(sizes) == 16 and max(sizes[2:]) < 1.05 * min(sizes[2:])


def test_overlapping_windows_shuffle_each_row_about_once(spark):
    df = panel(spark, {"a": [float(i) for i in range(600)], "b": [float(-i) for i in range(70)]})
    starts = L.window_starts(df, 20, 10, 1)
    got = {(r.entity, r.start_idx): r for r in L.window_samples(df, starts, 20, 10, size=300).collect()}
    assert set(got) == {("a", i) for i in range(571)} | {("b", i) for i in range(41)}
    assert all(r.context == [(1 if e == "a" else -1) * float(i + k) for k in range(20)] and len(r.target) == 10
               for (e, i), r in got.items())
    near = S.spread(df, "time_idx", 0, 30, 300)
    assert near.count() <= df.count() * (1 + 30 / 300) + 30
    gap = L.window_samples(df.filter("time_idx <> 100"), starts, 20, 10, size=300)
    assert {r.start_idx for r in gap.filter("entity = 'a'").collect()} == set(range(571)) - set(range(71, 101))


@pytest.mark.parametrize("size", [3, 1000])
def test_facts_meet_rows_slab_by_slab(spark, size):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = panel(spark, {"a": [1.0] * 40, None: [2.0] * 5, "z": [3.0] * 4})
        facts = spark.createDataFrame([("a", 10), (None, 20), ("q", 30)], "entity string, f int")
        for how, n in (("inner", 45), ("left", 49), ("left_semi", 45)):
            out = S.on_slabs(df, facts, ["entity"], S.slab_of("time_idx", size), how)
            assert out.columns == df.columns + ([] if how == "left_semi" else ["f"]) and out.count() == n
            if how == "inner":
                assert {(r.entity, r.f) for r in out.collect()} == {("a", 10), (None, 20)}
                plan = out._jdf.queryExecution().executedPlan().toString()
                assert "_slab" in plan.split("Exchange hashpartitioning(")[1].split(")")[0] + plan.split(
                    "Exchange hashpartitioning(")[2]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
