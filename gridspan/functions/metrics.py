"""Forecast errors and the cost of imbalance as aggregate expressions.

Every function returns a Column usable in ``agg`` at any grouping; no UDAF is involved, so
all metrics of a group come from one map-side-combined pass.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-8


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


@dataclass(frozen=True)
class EvalSpec:
    """Columns of an evaluation frame."""

    y: str = "y"
    pred: str = "pred"
    dam: str = "dam_price"
    sell: str = "sell_bm_price"
    buy: str = "buy_bm_price"
    price_scale: float = 1000.0


EVAL = EvalSpec()


def smape_row(y, pred) -> Column:
    y, pred = _col(y), _col(pred)
    return F.abs(y - pred) / F.greatest((F.abs(y) + F.abs(pred)) / 2, F.lit(EPS))


def smape(y, pred) -> Column:
    """Symmetric error in percent of the mean magnitude."""
    return F.avg(smape_row(y, pred)) * 100


def rmse(y, pred) -> Column:
    d = _col(y) - _col(pred)
    return F.sqrt(F.avg(d * d))


def mape(y, pred) -> Column:
    """Percent error over the rows with a non-zero actual."""
    y, pred = _col(y), _col(pred)
    return F.avg(F.when(y != 0, F.abs((y - pred) / y))) * 100


def mae(y, pred) -> Column:
    return F.avg(F.abs(_col(y) - _col(pred)))


def bias(y, pred) -> Column:
    return F.sum(_col(pred)) - F.sum(_col(y))


def ideal_spend(spec: EvalSpec = EVAL) -> Column:
    """Row cost of buying exactly the consumption on the day-ahead market."""
    return F.col(spec.y) * F.col(spec.dam) / F.lit(spec.price_scale)


def extra_cost(spec: EvalSpec = EVAL) -> Column:
    """Row cost caused by the error: surplus is sold back, shortage is bought in."""
    scale = F.lit(spec.price_scale)
    d = F.col(spec.pred) - F.col(spec.y)
    dam, sell, buy = (F.col(c) / scale for c in (spec.dam, spec.sell, spec.buy))
    correction = F.when(d > 0, sell * d).when(d < 0, buy * d).otherwise(F.lit(0.0))
    return d * dam - correction


def money(spec: EvalSpec = EVAL) -> Column:
    return F.sum(extra_cost(spec))


def money_pct(spec: EvalSpec = EVAL) -> Column:
    return F.try_divide(F.sum(extra_cost(spec)), F.sum(ideal_spend(spec)) / 100)


def money_pct_rows(spec: EvalSpec = EVAL) -> Column:
    """Mean of the row percentages, with a floor under the denominator."""
    return F.avg(extra_cost(spec) / F.greatest(ideal_spend(spec), F.lit(EPS))) * 100


def mean_cost(spec: EvalSpec = EVAL) -> Column:
    return F.avg(extra_cost(spec))


def combined(spec: EvalSpec = EVAL, weight: float = 0.2) -> Column:
    """Selection score: cost percent plus a share of the symmetric error."""
    return money_pct(spec) + F.lit(weight) * smape(spec.y, spec.pred)


def all_metrics(spec: EvalSpec = EVAL) -> dict[str, Column]:
    y, p = spec.y, spec.pred
    return {
        "n": F.count("*"), "smape": smape(y, p), "rmse": rmse(y, p), "mape": mape(y, p),
        "mae": mae(y, p), "bias": bias(y, p), "money": money(spec),
        "money_pct": money_pct(spec),
    }
