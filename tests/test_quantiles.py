import numpy as np
import pytest
from pyspark.sql import functions as F

from gridspan.plans.quantiles import exact_quantiles

PROBS = {"q0": 0.0, "m": 0.5, "q9": 0.973}


def check(df, keys, values):
    got = {tuple(r[k] for k in keys): r for r in exact_quantiles(df, keys, "v", PROBS, few=200).collect()}
    assert set(got) == set(values)
    for k, want in values.items():
        assert got[k]["n"] == len(want)
        assert [got[k][p] for p in PROBS] == pytest.approx([np.quantile(want, p) for p in PROBS.values()])


def test_wide_groups_ties_and_outliers(spark):
    rng = np.random.default_rng(3)
    values = {("normal",): rng.normal(size=30_000), ("two",): np.repeat([1.0, 2.0], [9_000, 11_000]),
              ("heavy ends",): np.concatenate([np.zeros(5_000), rng.random(400), np.ones(5_000)]),
              ("outlier",): np.concatenate([rng.random(9_000), [1e300, -1e300]]), ("small",): np.array([3.0, 1.0]),
              ("one",): np.array([7.0]), (None,): rng.integers(0, 50, 4_000).astype(float)}
    rows = [(k[0], float(x)) for k, v in values.items() for x in v] + [("empty", None), ("one", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(6)
    check(df, ["k"], values)
    check(df, [], {(): np.concatenate(list(values.values()))})


def test_poor_sketches_only_take_more_passes(spark):
    df = spark.range(20_000).select(((F.col("id") * 7919) % 20_000).cast("double").alias("v"))
    got = exact_quantiles(df, [], "v", {"m": 0.5, "q": 0.999}, accuracy=600, few=100).first()
    assert (got["m"], got["q"]) == (9999.5, pytest.approx(np.quantile(np.arange(20_000), 0.999)))


def test_no_rows(spark):
    assert exact_quantiles(spark.createDataFrame([], "k string, v double"), ["k"], "v", {"m": 0.5}).count() == 0
