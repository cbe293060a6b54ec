"""Queries over forecast evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import metrics as M
from ..operators import clean as K
from ..operators import evaluate as V
from ..plans.lineage import new_path
from ..sources import sinks as W
from . import fixtures as X
from .registry import query, with_

_SMAPE = "avg(abs(y - pred) / greatest((abs(y) + abs(pred)) / 2, 1e-8)) * 100"
_RMSE = "sqrt(avg((y - pred) * (y - pred)))"
_MAPE = "avg(abs((y - pred) / y)) FILTER (y <> 0) * 100"
_EXTRA = """((pred - y) * dam_price / 1000 - CASE WHEN pred - y > 0 THEN sell_bm_price / 1000 * (pred - y)
  WHEN pred - y < 0 THEN buy_bm_price / 1000 * (pred - y) ELSE 0 END)"""
_IDEAL = "(y * dam_price / 1000)"
_MONEY = f"sum({_EXTRA})"
_PCT = f"sum({_EXTRA}) / (sum({_IDEAL}) / 100)"
_ALL = f"""count(*) AS n, {_SMAPE} AS smape, {_RMSE} AS rmse, {_MAPE} AS mape, avg(abs(y - pred)) AS mae,
  sum(pred) - sum(y) AS bias, {_MONEY} AS money, {_PCT} AS money_pct"""
_NAMES = "smape rmse mape mae bias money money_pct"


def _one(name: str, sql: str, column):
    @query(name, with_(X.s_forecasts(), body=f"SELECT entity, {sql} AS value FROM forecasts GROUP BY entity"),
           "value")
    def run(spark, d):
        return X.forecasts(spark, d).groupBy("entity").agg(column().alias("value"))
    return run


_one("g1_smape", _SMAPE, lambda: M.smape("y", "pred"))
_one("g2_rmse", _RMSE, lambda: M.rmse("y", "pred"))
_one("g3_mape", _MAPE, lambda: M.mape("y", "pred"))
_one("g4_money", _MONEY, lambda: M.money())
_one("g5_money_pct", _PCT, lambda: M.money_pct())
_one("g8_combined_score", f"{_PCT} + 0.2 * {_SMAPE}", lambda: M.combined())


@query("g6_cost_modes", with_(X.s_forecasts(), body=f"""SELECT entity, {_MONEY} AS cost_abs, {_PCT} AS cost_pct,
  avg({_EXTRA} / greatest({_IDEAL}, 1e-8)) * 100 AS cost_pct_rows, avg({_EXTRA}) AS cost_per_hour FROM forecasts
  GROUP BY entity"""), "cost_abs cost_pct cost_pct_rows cost_per_hour")
def g6(spark, d):
    return V.cost_modes(X.forecasts(spark, d), ["entity"])


@query("g7_mae_bias_cost", with_(X.s_forecasts(), body=f"""SELECT avg(abs(y - pred)) AS mae, sum(pred) - sum(y) AS
  bias, avg({_EXTRA}) AS cost_per_hour FROM forecasts"""), "mae bias cost_per_hour")
def g7(spark, d):
    return X.forecasts(spark, d).agg(M.mae("y", "pred").alias("mae"), M.bias("y", "pred").alias("bias"),
                                     M.mean_cost().alias("cost_per_hour"))


@query("g9_score_by_entity", with_(X.s_forecasts(), body=f"SELECT entity, {_ALL} FROM forecasts GROUP BY entity"),
       _NAMES)
def g9(spark, d):
    return V.score(V.scorable(X.forecasts(spark, d)), ["entity"])


@query("g9_score_suppliers", with_(X.S_SUPPLIER, """lagged AS (SELECT *, lag(y, 7) OVER (PARTITION BY entity ORDER BY
  ts) AS pred, 3000.0 AS dam_price, 2000.0 AS sell_bm_price, 4000.0 AS buy_bm_price FROM (SELECT entity, unnest(
  generate_series(min(ts), max(ts), INTERVAL 1 DAY)) AS ts FROM sdaily GROUP BY entity) c LEFT JOIN sdaily USING
  (entity, ts))""", body=f"""SELECT entity, {_ALL} FROM lagged WHERE y IS NOT NULL AND pred IS NOT NULL
  GROUP BY entity"""), _NAMES, 3)
def g9_suppliers(spark, d):
    from ..operators.features import lag_columns
    from ..operators.grid import full_grid
    g = full_grid(X.supplier_daily(spark, d), X.DAILY)
    f = lag_columns(g, [7], X.DAILY).withColumnRenamed("lag_7", "pred")
    f = f.withColumn("dam_price", F.lit(3000.0)).withColumn("sell_bm_price", F.lit(2000.0)).withColumn(
        "buy_bm_price", F.lit(4000.0))
    return V.score(V.scorable(f), ["entity"])


@query("g9_score_summary", with_(X.s_forecasts(), f"per AS (SELECT entity, {_ALL} FROM forecasts GROUP BY entity)",
                                 body=f"""SELECT count(*) AS groups, avg(smape) AS mean_smape, avg(mape) AS mean_mape,
  avg(rmse) AS mean_rmse, sum(money) AS total_money, (SELECT {_SMAPE} FROM forecasts) AS global_smape,
  (SELECT {_MAPE} FROM forecasts) AS global_mape FROM per"""),
       "mean_smape mean_mape mean_rmse total_money global_smape global_mape")
def g9_summary(spark, d):
    return V.score_summary(X.forecasts(spark, d), ["entity"])


@query("g10_daily_scores", with_(X.s_forecasts(), body=f"""SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
  count(*) AS n, {_MAPE} AS mape, {_SMAPE} AS smape, sum(y) AS actual_sum, sum(pred) AS pred_sum,
  sum(pred) - sum(y) AS bias_sum FROM forecasts GROUP BY 1"""), "mape smape actual_sum pred_sum bias_sum")
def g10(spark, d):
    return V.score_days(X.forecasts(spark, d), "ts").withColumn("day", F.col("day").cast("string"))


@query("g10_mean_of_days", with_(X.s_forecasts(), f"""days AS (SELECT CAST(ts AS DATE) AS day, {_MAPE} AS m,
  {_SMAPE} AS s FROM forecasts GROUP BY 1)""", body="SELECT avg(m) AS avg_daily_mape, avg(s) AS avg_daily_smape "
                                                   "FROM days"), "avg_daily_mape avg_daily_smape")
def g10_mean(spark, d):
    return V.score_days(X.forecasts(spark, d), "ts").agg(F.avg("mape").alias("avg_daily_mape"),
                                                         F.avg("smape").alias("avg_daily_smape"))


# Three models from one pass over the grid: the value 48, 72 and 168 hours ago.
_MODELS = X.S_GRID + ", " + X.S_PRICES + """, models AS (SELECT g.entity, g.ts, g.y, p.*EXCLUDE (ts), model, pred,
  CASE WHEN g.ts < TIMESTAMP '2024-01-20' THEN 'val' ELSE 'test' END AS data_subset FROM (
  SELECT *, unnest(['lag_168', 'lag_48', 'lag_72']) AS model, unnest([lag(y, 168) OVER w, lag(y, 48) OVER w,
  lag(y, 72) OVER w]) AS pred FROM grid WINDOW w AS (PARTITION BY entity ORDER BY ts)) g JOIN prices p ON p.ts = g.ts
  WHERE g.y IS NOT NULL AND pred IS NOT NULL)"""


def _models(spark, d):
    from ..operators.features import lag_columns
    from ..operators.grid import label_splits
    wide = lag_columns(X.full(spark, d), [48, 72, 168], size=336)
    long = wide.select("entity", "ts", "time_idx", "y", F.explode(F.create_map(*[
        x for k in (48, 72, 168) for x in (F.lit(f"lag_{k}"), F.col(f"lag_{k}"))])).alias("model", "pred"))
    rows = long.dropna(subset=["y", "pred"]).join(X.prices(spark, d), "ts")
    return label_splits(rows, "2000-01-01", "2024-01-20")


_SCORES = f"scores AS (SELECT model, data_subset, {_ALL} FROM models GROUP BY 1, 2)"


@query("g11_models_by_split", with_(_MODELS, _SCORES, body="""SELECT s.*, s.money_pct - b.money_pct AS
  delta_money_pct, s.smape - b.smape AS delta_smape FROM scores s JOIN scores b ON b.data_subset = s.data_subset
  AND b.model = 'lag_168'"""), _NAMES + " delta_money_pct delta_smape")
def g11(spark, d):
    return V.score_models(_models(spark, d), "lag_168")


@query("a12_leaderboard", with_(_MODELS, _SCORES, body="""SELECT model, money_pct, CAST(row_number() OVER (ORDER BY
  money_pct, model) AS INTEGER) AS rank FROM scores WHERE data_subset = 'test'"""), "money_pct")
def a12(spark, d):
    test = _models(spark, d).filter("data_subset = 'test'")
    return V.leaderboard(V.score(test, ["model"]).select("model", "money_pct"))


@query("d16_pick_orders", with_(_MODELS, body=f"""SELECT entity, order_id, aic, val_money_pct FROM (SELECT *,
  row_number() OVER (PARTITION BY entity ORDER BY val_money_pct, aic, order_id) AS r2 FROM (SELECT *, row_number()
  OVER (PARTITION BY entity ORDER BY aic, order_id) AS r FROM (SELECT entity, model AS order_id, {_RMSE} AS aic,
  {_PCT} AS val_money_pct FROM models GROUP BY 1, 2)) WHERE r <= 2) WHERE r2 = 1"""), "aic val_money_pct")
def d16(spark, d):
    c = _models(spark, d).groupBy("entity", F.col("model").alias("order_id")).agg(
        M.rmse("y", "pred").alias("aic"), M.money_pct().alias("val_money_pct"))
    return V.pick_orders(c, "entity", 2)


@query("g12_quick_score")
def g12(spark, d):
    return V.quick_score(X.forecasts(spark, d), entities=3)


@query("q19_min_abs_actual", with_(X.s_forecasts(), body=f"""SELECT entity, {_SMAPE} AS smape, count(*) AS n FROM
  forecasts WHERE abs(y) > 20 GROUP BY 1"""), "smape")
def q19(spark, d):
    return V.score(V.scorable(X.forecasts(spark, d), min_abs_actual=20), ["entity"]).select("entity", "smape", "n")


@query("a11_metric_log", with_(X.s_forecasts(), f"per AS (SELECT entity, {_ALL} FROM forecasts GROUP BY entity)",
                               body="""SELECT run, entity, metric, value FROM (SELECT unnest(['r1', 'r2']) AS run,
  entity, unnest(['n', 'n']) AS metric, unnest([CAST(n AS DOUBLE), n]) AS value FROM per UNION ALL SELECT
  unnest(['r1', 'r2']), entity, unnest(['smape', 'smape']), unnest([smape, smape]) FROM per)"""), "value")
def a11(spark, d):
    path = new_path(spark, "metrics")
    scores = V.score(X.forecasts(spark, d), ["entity"]).select("entity", "n", "smape")
    W.log_metrics(scores, path, "r1", ["entity"])
    W.log_metrics(scores, path, "r2", ["entity"])
    return spark.read.parquet(path)


@query("s3_prequential", with_(X.s_forecasts(), """run AS (SELECT entity, time_idx, count(*) OVER w AS seen,
  avg(CASE WHEN y <> 0 THEN abs((y - pred) / y) END) OVER w * 100 AS mape, avg(abs(y - pred) / greatest((abs(y)
  + abs(pred)) / 2, 1e-8)) OVER w * 100 AS smape, sqrt(avg((y - pred) * (y - pred)) OVER w) AS rmse FROM forecasts
  WINDOW w AS (PARTITION BY entity ORDER BY time_idx ROWS UNBOUNDED PRECEDING))""",
                               body="SELECT * FROM run WHERE seen % 50 = 0"), "mape smape rmse")
def s3(spark, d):
    return V.prequential(X.forecasts(spark, d), 50, size=100)
