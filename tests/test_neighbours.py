"""Nearest neighbours in one join of cells at each place's own level."""


import numpy as np
import pytest

from gridspan.operators import joins as J


def brute(points, k):
    """The k nearest by rounded distance and key."""
    ids = sorted(points)
    la, lo = (np.radians([points[i][j] for i in ids]) for j in (0, 1))
    half = (np.sin((la[:, None] - la[None]) / 2) ** 2
            + np.cos(la[:, None]) * np.cos(la[None]) * np.sin((lo[:, None] - lo[None]) / 2) ** 2)
    km = np.round(2 * 6371.0088 * np.arcsin(np.sqrt(np.minimum(half, 1))), 6)
    return {i: [ids[b] for b in np.lexsort((ids, km[a])) if b != a][:k] for a, i in enumerate(ids)}


def found(spark, points, k, **more):
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in points.items()], "id int, la double, lo double")
    got = {}
    for r in J.nearest(df, "id", "la", "lo", k, **more).orderBy("src", "rank").collect():
        got.setdefault(r.src, []).append(r.dst)
    return got


@pytest.mark.parametrize("seed", [0, 1])
def test_dense_sparse_and_polar_places(spark, seed):
    rng, pts = np.random.default_rng(seed), {}
    for lat, lon, spread, n in ((50, 30, 1e-4, 120), (50.2, 30.2, 0.05, 120), (-33, 179.99, 0.02, 60), (89.9, 0, 0.2, 40),
                                (0, 0, 60, 80), (70, -120, 3, 60)):
        for _ in range(n):
            pts[len(pts)] = (float(np.clip(rng.normal(lat, spread), -90, 90)), (rng.normal(lon, spread) + 180) % 360 - 180)
    pts |= {len(pts): (90.0, 0.0), len(pts) + 1: (-90.0, 45.0), len(pts) + 2: (0.0, 180.0), len(pts) + 3: (0.0, -180.0)}
    assert found(spark, pts, 5) == brute(pts, 5)


def test_cells_coarser_than_the_crowd(spark):
    """With few levels the finest cell holds everything; results stay."""
    rng = np.random.default_rng(5)
    pts = {i: (50 + rng.normal(0, 1e-3), 30 + rng.normal(0, 1e-3)) for i in range(80)}
    assert found(spark, pts, 3, top=4) == found(spark, pts, 3) == brute(pts, 3)


def test_levels_follow_density(spark):
    """Dense places get fine cells, so they do not meet all members; only lonely ones use coarse cells."""
    rng = np.random.default_rng(2)
    rows = [(i, 50 + rng.normal(0, 0.01), 30 + rng.normal(0, 0.01)) for i in range(2000)] + [
        (2000 + i, -10.0 - i, -60.0 + 2 * i) for i in range(5)]
    df = spark.createDataFrame([(i, float(a), float(b)) for i, a, b in rows], "id int, lat double, lon double")
    got = J.search_levels(df, 5, 24).select("lat", "level").collect()
    dense = [r.level for r in got if r.lat > 0]
    assert np.median(dense) >= 13 and all(r.level < 8 for r in got if r.lat < 0)
    per_cell = sum(1 for r in got if r.level < 8)
    assert per_cell <= 40


def test_one_plan_without_a_driver_loop(spark):
    df = spark.createDataFrame([(i, float(i), float(2 * i)) for i in range(30)], "id int, lat double, lon double")
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup("near"))
    spark.sparkContext.setJobGroup("near", "near")
    try:
        plan = J.nearest(df, "id", "lat", "lon", 3)._jdf.queryExecution().optimizedPlan().toString()
        assert jobs() == 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert "Join Cross" not in plan


def test_unknown_coordinates_ties_and_empty(spark):
    schema = "id int, lat double, lon double, level int, distance double"
    df = spark.createDataFrame([(1, 50.0, 30.0, 0, 0.0), (2, None, 30.0, 0, 0.0), (3, 50.0, 31.0, 0, 0.0),
                                (4, 50.0, 29.0, 0, 0.0), (5, 50.0, 30.0, 0, 0.0)], schema)
    got = {(r.src, r["rank"]): r.dst for r in J.nearest(df, "id", "lat", "lon", 2).collect()}
    assert {r for r, _ in got} == {1, 3, 4, 5}
    assert got[1, 1] == 5 and got[5, 1] == 1 and got[1, 2] == 3 and got[3, 1] == 1
    assert J.nearest(df.filter("false"), "id", "lat", "lon", 2).count() == 0


def test_few_members_are_met_per_place(spark):
    """The cells searched hold a bounded number of members a place, and the reach leaves hardly more than asked for."""
    rng, k = np.random.default_rng(7), 5
    pts = {i: (45 + 4 * rng.random(), 20 + 6 * rng.random()) for i in range(3000)}
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in pts.items()], "id int, lat double, lon double")
    got = J.search_levels(df, k, 24).collect()
    assert len(got) == 3000
    lat, lon = (np.array([p[j] for p in pts.values()]) for j in (0, 1))
    met, within = [], []
    for r in got:
        size = 360 / 2 ** r.level
        near = [np.abs(np.floor((a + b) / size) - np.floor((c + b) / size)) <= 1 for a, c, b in ((lat, r.lat, 90), (lon, r.lon, 180))]
        half = (np.sin(np.radians(lat - r.lat) / 2) ** 2
                + np.cos(np.radians(lat)) * np.cos(np.radians(r.lat)) * np.sin(np.radians(lon - r.lon) / 2) ** 2)
        close = 2 * 6371.0088 * np.arcsin(np.sqrt(half)) <= r.reach
        assert k < close.sum() <= 10 * (k + 1) and not (close & ~(near[0] & near[1])).any()
        met.append((near[0] & near[1]).sum())
        within.append(close.sum())
    assert np.mean(met) < 250 and np.mean(within) < 3 * (k + 1)
    assert found(spark, pts, k) == brute(pts, k)


def test_crowd_within_one_cell_of_the_finest_level(spark):
    """More members in one finest cell than a block holds, and a lonely place beside them."""
    pts = {i: (50 + 1e-7 * (i % 9), 30 + 1e-7 * (i // 9)) for i in range(90)} | {90: (50.3, 30.3), 91: (50.0, 30.0)}
    assert found(spark, pts, 3) == brute(pts, 3)
