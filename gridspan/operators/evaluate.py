"""Scoring of evaluation frames at any grouping, leaderboards and rankings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import metrics as M
from ..functions.metrics import EVAL, EvalSpec
from ..plans.slabs import DEFAULT_SLAB, running_sums
from ..spec import PANEL, PanelSpec
from .clean import first_rows, sample_entities


def scorable(df: DataFrame, spec: EvalSpec = EVAL, min_abs_actual: float | None = None) -> DataFrame:
    """Rows with prediction, actual and prices; optionally without near-zero actuals."""
    kept = df.dropna(subset=[spec.y, spec.pred, spec.dam, spec.sell, spec.buy])
    return kept if min_abs_actual is None else kept.filter(F.abs(spec.y) > min_abs_actual)


def score(df: DataFrame, by: Sequence[str] = (), spec: EvalSpec = EVAL) -> DataFrame:
    """All metrics per group, in one aggregation."""
    return df.groupBy(*by).agg(*[e.alias(n) for n, e in M.all_metrics(spec).items()])


def cost_modes(df: DataFrame, by: Sequence[str] = (), spec: EvalSpec = EVAL) -> DataFrame:
    return df.groupBy(*by).agg(M.money(spec).alias("cost_abs"), M.money_pct(spec).alias("cost_pct"),
                               M.money_pct_rows(spec).alias("cost_pct_rows"),
                               M.mean_cost(spec).alias("cost_per_hour"))


def score_summary(df: DataFrame, by: Sequence[str], spec: EvalSpec = EVAL) -> DataFrame:
    """Mean of the group metrics, total cost, and the metrics of all rows."""
    groups = score(df, by, spec).agg(
        F.count("*").alias("groups"), F.avg("smape").alias("mean_smape"),
        F.avg("mape").alias("mean_mape"), F.avg("rmse").alias("mean_rmse"),
        F.sum("money").alias("total_money"))
    whole = score(df, (), spec)
    return groups.select("*", whole.select("smape").scalar().alias("global_smape"),
                         whole.select("mape").scalar().alias("global_mape"))


def score_days(df: DataFrame, ts: str, by: Sequence[str] = (), spec: EvalSpec = EVAL) -> DataFrame:
    return (df.groupBy(*by, F.to_date(ts).alias("day"))
            .agg(F.count("*").alias("n"), M.mape(spec.y, spec.pred).alias("mape"),
                 M.smape(spec.y, spec.pred).alias("smape"), F.sum(spec.y).alias("actual_sum"),
                 F.sum(spec.pred).alias("pred_sum"), M.bias(spec.y, spec.pred).alias("bias_sum")))


def score_models(df: DataFrame, reference: str, model: str = "model", split: str = "data_subset",
                 spec: EvalSpec = EVAL) -> DataFrame:
    """Metrics per model and split with the difference to a reference model."""
    scores = score(df, [model, split], spec)
    base = (scores.filter(F.col(model) == reference)
            .select(split, F.col("money_pct").alias("_m"), F.col("smape").alias("_s")))
    return scores.join(base, split, "left").select(
        *scores.columns, (F.col("money_pct") - F.col("_m")).alias("delta_money_pct"),
        (F.col("smape") - F.col("_s")).alias("delta_smape"))


def leaderboard(scores: DataFrame, metric: str = "money_pct", by: Sequence[str] = (),
                tie: str = "model") -> DataFrame:
    """Rank of each model by a metric (score tables have one row per model)."""
    part = [F.col(c) for c in by] or [F.lit(0)]
    return scores.withColumn("rank", F.row_number().over(
        Window.partitionBy(*part).orderBy(F.col(metric).asc_nulls_last(), tie)))


def extremes(scores: DataFrame, metric: str, n: int, tie: str) -> DataFrame:
    """Best and worst ``n`` rows by a metric (two bounded top-n selections)."""
    known = scores.filter(F.col(metric).isNotNull())
    best = known.orderBy(F.col(metric).asc(), tie).limit(n).withColumn("side", F.lit("best"))
    worst = known.orderBy(F.col(metric).desc(), tie).limit(n).withColumn("side", F.lit("worst"))
    return best.unionByName(worst)


def pick_orders(candidates: DataFrame, group: str, top: int = 5, aic: str = "aic",
                cost: str = "val_money_pct", tie: str = "order_id") -> DataFrame:
    """Per group the cheapest of the ``top`` candidates by information criterion."""
    w = Window.partitionBy(group).orderBy(aic, tie)
    short = candidates.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= top).drop("_r")
    best = Window.partitionBy(group).orderBy(F.col(cost).asc_nulls_last(), aic, tie)
    return short.withColumn("_r", F.row_number().over(best)).filter("_r = 1").drop("_r")


def quick_score(df: DataFrame, entities: int = 16, horizon: int = 48, seed: int = 42,
                panel: PanelSpec = PANEL, spec: EvalSpec = EVAL) -> DataFrame:
    """Cost on the first horizon of a few seeded entities: a cheap stand-in for the full score."""
    some = sample_entities(df, entities, seed, panel)
    return cost_modes(first_rows(some, horizon, panel, panel.idx), (), spec)


def prequential(df: DataFrame, every: int, panel: PanelSpec = PANEL, spec: EvalSpec = EVAL,
                size: int = DEFAULT_SLAB) -> DataFrame:
    """Metrics over everything seen so far, reported at each ``every``-th row of an entity."""
    y, p = F.col(spec.y), F.col(spec.pred)
    sums = {
        "seen": F.lit(1), "_ape": F.when(y != 0, F.abs((y - p) / y)),
        "_nz": F.when(y != 0, 1).otherwise(0), "_sm": M.smape_row(y, p), "_sq": (y - p) * (y - p),
    }
    run = running_sums(df, [panel.entity], panel.idx, sums, size)
    return run.filter(F.col("seen") % every == 0).select(
        panel.entity, panel.idx, "seen",
        (F.try_divide(F.col("_ape"), F.col("_nz")) * 100).alias("mape"),
        (F.col("_sm") / F.col("seen") * 100).alias("smape"),
        F.sqrt(F.col("_sq") / F.col("seen")).alias("rmse"))
