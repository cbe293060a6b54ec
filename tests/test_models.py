"""Model search, streams and neighbours against brute force on small fixtures."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridspan.operators import features as L
from gridspan.operators import joins as J
from gridspan.operators import search as A
from gridspan.operators import trees
from gridspan.plans.lineage import cut, new_path, shared_folder
from gridspan.streaming import enrich, progressive


def series(n=400, seed=0, entity="a"):
    rng = np.random.default_rng(seed)
    t = np.arange(n)
    y = 50 + 10 * np.sin(2 * np.pi * t / 24) + 0.01 * t + rng.normal(0, 1, n)
    return pd.DataFrame({"entity": entity, "time_idx": t, "y": y, "x": rng.normal(0, 1, n),
                         "ts": pd.Timestamp("2024-01-01") + pd.to_timedelta(t, "h")})


def spark_frame(spark, pdf):
    return spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def test_decomposition_matches_direct(spark):
    pdf = series()
    y = pdf.y.to_numpy()
    w = np.r_[0.5, np.ones(23), 0.5] / 24
    trend = np.full(len(y), np.nan)
    trend[12:-12] = np.convolve(y, w, "valid")
    phase = np.array([np.nanmean((y - trend)[i::24]) for i in range(24)])
    season = (phase - phase.mean())[np.arange(len(y)) % 24]
    got = L.decompose(spark_frame(spark, pdf), size=50).toPandas().sort_values("time_idx")
    np.testing.assert_allclose(got.trend, trend, rtol=1e-10)
    np.testing.assert_allclose(got.seasonal, season, atol=1e-9)
    line = L.trend_line(L.decompose(spark_frame(spark, pdf), size=50), 72).first()
    known = trend[~np.isnan(trend)][-336:]
    cap = 0.2 * abs(known[-1]) / 72
    assert line.level == pytest.approx(known[-1])
    assert line.slope == pytest.approx(np.clip(np.median(np.diff(known)), -cap, cap))


def test_fits_match_least_squares(spark):
    pdf = pd.concat([series(entity="a"), series(seed=3, n=300, entity="b")])
    dec = cut(L.decompose(spark_frame(spark, pdf), size=64).join(
        spark_frame(spark, pdf).select("entity", "time_idx", F.col("x").alias("x2")), ["entity", "time_idx"]))
    orders = A.orders_grid((1, 2, 3), (0, 1))
    got = {(r.entity, r.order_id): r for r in A.fit_orders(dec, orders, ["x2"], size=64).collect()}
    assert len(got) == 12
    for e, g in dec.toPandas().sort_values("time_idx").groupby("entity"):
        r, x = g.resid.to_numpy(), g.x2.to_numpy()
        step = lambda v: np.r_[np.nan, np.diff(v)]
        four = np.column_stack([r] + [np.r_[np.full(k, np.nan), r[:-k]] for k in range(1, 5)] + [step(x)])
        common = ~np.isnan(four).any(axis=1)
        assert {got[e, i].n for i in range(len(orders))} == {common.sum()}
        for i, (p, d) in enumerate(orders):
            z, u = (step(r), step(x)) if d else (r, x)
            cols = [np.ones(len(z))] + [np.r_[np.full(k, np.nan), z[:-k]] for k in range(1, 4)] + [u]
            full = np.column_stack([*cols, z])[common]
            use = [0, *range(1, 1 + p), 4]
            beta, *_ = np.linalg.lstsq(full[:, use], full[:, -1], rcond=None)
            np.testing.assert_allclose(got[e, i].coef, beta, atol=1e-6)
            sse = ((full[:, -1] - full[:, use] @ beta) ** 2).sum()
            assert got[e, i].aic == pytest.approx(len(full) * math.log(sse / len(full)) + 2 * (len(use) + 1), rel=1e-6)


def test_residual_walk_by_hand():
    xs = np.zeros((3, 0))
    np.testing.assert_allclose(A.walk(np.array([1.0, 0.5]), 1, 0, np.array([3.0, 4.0]), xs), [3.0, 2.5, 2.25])
    np.testing.assert_allclose(A.walk(np.array([0.0, 0.5]), 1, 1, np.array([3.0, 4.0]), xs), [4.5, 4.75, 4.875])


def test_cluster_representatives(spark):
    pdf = pd.concat([series(seed=i, entity=f"e{i}") for i in range(6)])
    c = A.cluster_entities(spark_frame(spark, pdf), clusters=2).toPandas()
    for _, g in c.groupby("cluster"):
        assert g.representative.sum() == 1
        assert g.loc[g.representative, "distance"].iloc[0] == g.distance.min()


def test_fallback_order(spark):
    members = spark.createDataFrame([("a", 0), ("b", 0), ("c", 1), ("d", 2)], "entity string, cluster int")
    best = spark.createDataFrame([(0, 4, 2, 0, 1.0, 1.0), (2, 1, 1, 1, 1.0, 1.0)],
                                 "cluster int, order_id int, p int, d int, aic double, val_money_pct double")
    got = {r.entity: (r.order_id, r.fallback) for r in A._with_fallback(members, best, "cluster").collect()}
    assert got == {"a": (4, False), "b": (4, False), "c": (1, True), "d": (1, False)}


def brute_neighbours(pts, k):
    out = {}
    for a, (la, lo) in pts.items():
        ds = []
        for b, (lb, lp) in pts.items():
            if a != b:
                x = math.sin(math.radians(lb - la) / 2) ** 2 + math.cos(math.radians(la)) * math.cos(
                    math.radians(lb)) * math.sin(math.radians(lp - lo) / 2) ** 2
                ds.append((round(2 * 6371.0088 * math.asin(math.sqrt(min(x, 1))), 6), b))
        out[a] = [b for _, b in sorted(ds)[:k]]
    return out


def test_neighbours_of_a_clustered_map(spark):
    """A third of the members share one point, some are isolated, some lie across the date line."""
    rng = np.random.default_rng(1)
    pts = {i: (50.0, 30.0) for i in range(20)}
    pts |= {20 + i: (50 + rng.normal(0, 0.01), 30 + rng.normal(0, 0.01)) for i in range(20)}
    pts |= {40 + i: (rng.uniform(-85, 85), rng.uniform(-180, 180)) for i in range(15)}
    pts |= {55: (10.0, 179.9), 56: (10.0, -179.9), 57: (10.1, 180.0), 58: (89.0, 10.0), 59: (89.0, -170.0)}
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in pts.items()], "id int, la double, lo double")
    got = {}
    for r in J.nearest(df, "id", "la", "lo", 4).orderBy("src", "rank").collect():
        got.setdefault(r.src, []).append(r.dst)
    assert got == brute_neighbours(pts, 4)


def test_too_few_members(spark):
    df = spark.createDataFrame([(1, 50.0, 30.0), (2, 51.0, 31.0)], "id int, la double, lo double")
    assert J.nearest(df, "id", "la", "lo", 5).count() == 2
    g = J.neighbour_graph(J.nearest(df, "id", "la", "lo", 5))
    assert {(r.src, r.dst, r.weight) for r in g.collect()} == {(a, b, 0.5) for a in (1, 2) for b in (1, 2)}


def progressive_brute(pdf, names, ridge=1e-4):
    day, out = pdf.ts.dt.date, {}
    for d in sorted(day.unique()):
        past, now = pdf[day < d], pdf[day == d]
        x = np.column_stack([np.ones(len(now)), now[names]])
        if len(past):
            a = np.column_stack([np.ones(len(past)), past[names], past.y])
            beta, _ = A.solve(a.T @ a, list(range(len(names) + 1)), ridge)
            pred = x @ beta
        else:
            pred = np.zeros(len(now))
        out |= dict(zip(now.time_idx, pred))
    return out


def test_predict_then_learn_batch_and_stream(spark):
    pdf = series(n=120)
    df = spark_frame(spark, pdf)
    want = progressive_brute(pdf, ["x"])
    got = {r.time_idx: r.pred for r in progressive.predict_then_learn(df, ["x"]).collect()}
    assert got == {k: pytest.approx(v, abs=1e-6) for k, v in want.items()}

    landed, state, out, mark = (new_path(spark, s) for s in ("days", "state", "preds", "mark"))
    for i in range(5):
        df.filter(f"time_idx div 24 = {i}").coalesce(1).write.parquet(f"{landed}/d{i}")
    stream = lambda: (spark.readStream.schema(df.schema).option("recursiveFileLookup", "true")
                      .option("maxFilesPerTrigger", 1).parquet(landed))
    progressive.progressive_stream(stream(), ["x"], state, out, mark)
    progressive.progressive_stream(stream(), ["x"], state, out, mark)  # nothing new: no change
    got = {r.time_idx: r.pred for r in spark.read.parquet(out).collect()}
    assert got == {k: pytest.approx(v, abs=1e-6) for k, v in want.items()}


def test_enrichment_resumes_after_a_stop(spark):
    landed, out, mark = (new_path(spark, s) for s in ("src", "rich", "mark"))
    for i in range(3):
        spark.range(i * 5, i * 5 + 10).coalesce(1).write.parquet(f"{landed}/p{i}")  # overlapping keys
    stream = lambda: (spark.readStream.schema("id long").option("recursiveFileLookup", "true")
                      .option("maxFilesPerTrigger", 1).parquet(landed))
    calls = []
    stop = lambda: len(calls) >= 1

    def rich(b):
        calls.append(1)
        return b.withColumn("w", F.col("id") * 2)
    assert enrich.enrich_available(stream(), ["id"], rich, out, mark, stop) is False
    assert 0 < spark.read.parquet(out).count() < 20
    assert enrich.enrich_available(stream(), ["id"], rich, out, mark) is True
    got = spark.read.parquet(out)
    assert got.count() == 20 and got.select("id").distinct().count() == 20


def test_trials_and_cost_evaluator(spark):
    t = trees.random_trials({"a": [1, 2], "b": [1, 2]}, 10)
    assert len(t) == 4 and t == trees.random_trials({"a": [1, 2], "b": [1, 2]}, 10)
    df = spark.createDataFrame([("a", i, 10.0, 11.0 if i < 48 else 99.0, 5000.0, 3000.0, 7000.0) for i in range(60)],
                               "entity string, time_idx long, y double, pred double, dam_price double, "
                               "sell_bm_price double, buy_bm_price double")
    assert trees.CostEvaluator().evaluate(df) == pytest.approx(48 * (5 - 3))
    assert not trees.CostEvaluator().isLargerBetter()


def test_shared_folder_comes_from_the_session(spark):
    folder = shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir") and new_path(spark, "x").startswith(folder)
