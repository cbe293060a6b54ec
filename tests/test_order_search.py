"""Order search: a row and a status for every entity, one sample for all orders, two steps of production."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridspan.operators import search as A

PRICES = ("dam_price", "sell_bm_price", "buy_bm_price")


@pytest.fixture(scope="module")
def panel(spark):
    """One long series, one too short for any fit, one too short for a trend, one without a value."""
    rng, parts = np.random.default_rng(4), []
    for entity, n in (("long", 360), ("short", 40), ("tiny", 5), ("blank", 30)):
        t = np.arange(360 - n, 420)
        x = rng.normal(0, 1, len(t))
        y = 50 + 10 * np.sin(2 * np.pi * t / 24) + 3 * x + rng.normal(0, 0.2, len(t))
        parts.append(pd.DataFrame({"entity": entity, "time_idx": t, "y": y if entity != "blank" else np.nan, "x": x}))
    pdf = pd.concat(parts)
    pdf["ts"] = pd.Timestamp("2024-01-01") + pd.to_timedelta(pdf.time_idx, "h")
    df = spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz")).withColumn("y", F.nanvl("y", F.lit(None)))
    for i, c in enumerate(PRICES):
        df = df.withColumn(c, F.lit(1000.0 + 100 * i))
    return df


def parts(panel):
    return panel.filter("time_idx < 360"), panel.filter("time_idx >= 360 and time_idx < 390"), panel.filter("time_idx >= 390")


def test_every_entity_has_a_row_for_every_order(spark, panel):
    train, val, _ = parts(panel)
    got = A.candidate_search(train, val, [(0, 0), (1, 0), (2, 1)], exog=["x"], size=50).toPandas()
    assert got.groupby("entity").size().to_dict() == dict.fromkeys(("long", "short", "tiny", "blank"), 3)
    by = got.groupby("entity").status.agg(set)
    assert by["long"] == {"fitted"} and by["short"] == by["tiny"] == by["blank"] == {"short"}
    assert got[got.entity != "long"].aic.isna().all() and got[got.entity == "long"].val_money_pct.notna().all()


def test_search_falls_back_for_short_series(spark, panel):
    train, val, _ = parts(panel)
    got = A.entity_search(train, val, exog=["x"], size=50).toPandas().set_index("entity")
    assert len(got) == 4 and got.order_id.nunique() == 1
    assert got.fallback.to_dict() == {"long": False, "short": True, "tiny": True, "blank": True}
    assert A.common_order(train, exog=["x"], size=50).agg(F.sum("entities")).first()[0] == 1


def test_entities_without_rows_to_score_keep_their_row(spark, panel):
    train, val, _ = parts(panel)
    got = A.candidate_search(train, val.withColumn("y", F.lit(None).cast("double")), [(1, 0)], horizon=10, exog=["x"], size=50)
    assert {r.entity: r.status for r in got.collect()}["long"] == "unscored"


def test_production_in_two_steps(spark, panel):
    train, val, test = parts(panel)
    chosen = spark.createDataFrame([("long", 2), ("short", 2), ("tiny", 2)], "entity string, order_id int")
    got = A.forecast_splits(train, val.drop("y").join(val.select("entity", "ts", "y"), ["entity", "ts"]), test, chosen,
                            ["x"], size=50).toPandas()
    assert got.groupby(["entity", "split"]).size().to_dict() == {
        (e, s): 30 for e in ("long", "short", "tiny", "blank") for s in ("val", "test")}
    status = got.groupby(["entity", "split"]).status.agg(set)
    assert status["long", "val"] == status["long", "test"] == {"fitted"}
    assert status["tiny", "val"] == {"short"} and status["blank", "val"] == {"not chosen"}
    assert status["blank", "test"] == {"not chosen"} and got[got.split == "test"].time_idx.min() == 390
    known = panel.filter("entity = 'tiny' and time_idx < 360").agg(F.avg("y")).first()[0]
    np.testing.assert_allclose(got[(got.entity == "tiny") & (got.split == "val")].pred, known)
    assert got.pred.notna().all()
    # The long series follows its regressor: far closer than its level alone.
    truth = panel.filter("entity = 'long' and time_idx >= 360").select("time_idx", "y").toPandas()
    both = got[got.entity == "long"].merge(truth, on="time_idx")
    assert np.abs(both.pred - both.y).mean() < 1.5


def test_regressors_ahead():
    np.testing.assert_allclose(A.drive_rows([1.0, np.nan], [2.0, np.nan, np.nan, 5.0], 2, 0), [[2, 5], [2, 5]])
    np.testing.assert_allclose(A.drive_rows([1.0, np.nan], [2.0, np.nan, np.nan, 5.0], 2, 1), [[1, 0], [0, 0]])


def test_differences_of_a_pure_regressor_effect(spark):
    """y follows 3 x exactly, so with d = 1 the coefficient of the differenced regressor is 3 as well."""
    rng = np.random.default_rng(0)
    t, x = np.arange(200), rng.normal(0, 1, 200)
    df = spark.createDataFrame(pd.DataFrame({"entity": "a", "time_idx": t, "resid": 3 * x, "x": x}))
    got = A.fit_orders(df, [(0, 0), (0, 1)], ["x"], size=32).toPandas()
    for coef in got.coef:
        np.testing.assert_allclose(coef, [0.0, 3.0], atol=1e-8)
    assert set(got.n) == {199}


def test_empty_panel(spark, panel):
    none = panel.filter("false")
    assert A.candidate_search(none, none, [(1, 0)], exog=["x"], size=50).count() == 0


def test_a_null_entity_is_an_entity(spark, panel):
    def unnamed(df):
        return df.filter("entity = 'long'").withColumn("entity", F.lit(None).cast("string"))
    train, val, _ = parts(panel)
    named = A.candidate_search(train.filter("entity = 'long'"), val, [(1, 0), (1, 1)], exog=["x"], size=50).toPandas()
    got = A.candidate_search(unnamed(train), unnamed(val), [(1, 0), (1, 1)], exog=["x"], size=50).toPandas()
    assert got.entity.isna().all() and (got.status == "fitted").all()
    np.testing.assert_allclose(got.sort_values("order_id").val_money_pct, named.sort_values("order_id").val_money_pct)
