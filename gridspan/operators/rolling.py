"""Rolling evaluation of any scorer on true history.

Origins are independent of each other.  Each becomes one row with its context and what is known of the
steps after it as arrays; a scorer sees rows of origins, in whatever batches Spark deals out.  The last
origin of a series may reach past its end: its arrays are padded with NULL and ``ahead`` tells
how many steps are real.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.slabs import DEFAULT_SLAB, SLAB, slab_arrays
from ..spec import PANEL, PanelSpec
from .clean import clip

#: From origins to rows (entity, ts, idx, y, origin_idx, lead, pred).
OriginScorer = Callable[[DataFrame], DataFrame]


def _cut(values: Column, first: Column, length: int) -> Column:
    """``length`` elements from 0-based ``first`` on, NULL where the array has none."""
    return F.transform(F.sequence(F.lit(0), F.lit(length - 1)), lambda i: F.get(values, (first + i).cast("int")))


def origin_windows(df: DataFrame, context: int, first: int | Column, every: int | None = None,
                   spec: PanelSpec = PANEL, size: int = DEFAULT_SLAB) -> DataFrame:
    """One row per entity and origin, on a complete grid.

    The first forecast step of the first origin is ``first``, origins follow ``every`` steps while a step is left.
    Columns: entity, origin_idx, ``ahead``, ``context`` (the last ``context`` values up to the origin, NULL before the series
    begins), ``target`` and ``target_ts`` (``every`` steps), ``past_<c>`` like context, ``ahead_<c>`` like
    target for future-known columns, statics as values.  Rows are copied for the context only,
    ``(context + every) / size`` times the input.
    """
    every = every or spec.horizon
    begin = F.lit(first) if isinstance(first, int) else first
    used = list(dict.fromkeys([spec.y, spec.ts, *spec.past_only, *spec.known_future, *spec.static]))
    near = slab_arrays(df.withColumn("_begin", begin.cast("long")), [spec.entity], spec.idx, [*used, "_begin"],
                       context, every, size)
    rows, slab = F.col("_rows"), F.col(SLAB)
    low, high = F.get(rows, F.lit(0)).getField(spec.idx), F.get(rows, F.size(rows) - 1).getField(spec.idx)
    before = F.get(rows, F.lit(0)).getField("_begin") - 1
    start = before + F.ceil(F.greatest(slab * size - before, F.lit(0)) / every) * every
    stop = F.least((slab + 1) * size - 1, high - 1)
    placed = near.withColumns({"_from": start.cast("long"), "_to": stop.cast("long"), "_low": low, "_high": high})
    one = placed.filter("_from <= _to").withColumn("origin_idx", F.explode(F.sequence("_from", "_to", F.lit(every).cast("long"))))
    at = F.col("origin_idx") - F.col("_low") + 1  # of the first step after the origin

    def past(c: str) -> Column:
        return _cut(rows.getField(c), at - context, context)

    def future(c: str) -> Column:
        return _cut(rows.getField(c), at, every)

    out = [F.least(F.col("_high") - F.col("origin_idx"), F.lit(every)).cast("int").alias("ahead"),
           past(spec.y).alias("context"), future(spec.y).alias("target"), future(spec.ts).alias("target_ts")]
    out += [past(c).alias(f"past_{c}") for c in spec.past_only]
    out += [future(c).alias(f"ahead_{c}") for c in spec.known_future]
    out += [F.get(rows.getField(c), F.greatest(at - 1, F.lit(0)).cast("int")).alias(c) for c in spec.static]
    return one.select(spec.entity, "origin_idx", *out)


def lead_rows(windows: DataFrame, lags: Sequence[int] = (), spec: PanelSpec = PANEL,
              pred: Column | None = None) -> DataFrame:
    """The real steps of each origin: keys, y, origin_idx, lead, statics, future-known columns and ``lag_<k>h``.

    Lags come from the context alone and must be at least as long as the origin's reach, so that none is after the origin.
    """
    leads = F.posexplode(F.slice(F.arrays_zip(
        F.col("target").alias("y"), F.col("target_ts").alias("ts"),
        *[F.col(f"ahead_{c}").alias(c) for c in spec.known_future],
        *([pred.alias("pred")] if pred is not None else [])), F.lit(1), F.col("ahead"))).alias("_at", "_row")
    keep = [c for c in ("context",) if lags]
    rows = windows.select(spec.entity, "origin_idx", *spec.static, *keep, leads)
    lead = F.col("_at") + 1
    out = [F.get("context", (F.size("context") + F.col("_at") - k).cast("int")).alias(f"lag_{k}h") for k in lags]
    return rows.select(
        spec.entity, F.col("_row.ts").alias(spec.ts), (F.col("origin_idx") + lead).alias(spec.idx),
        F.col("_row.y").alias(spec.y), "origin_idx", lead.cast("long").alias("lead"), *spec.static,
        *[F.col("_row").getField(c).alias(c) for c in spec.known_future], *out,
        *([F.col("_row.pred").alias("pred")] if pred is not None else []))


def rolling_evaluation(df: DataFrame, scorer: OriginScorer, context: int, first: int | Column,
                       every: int | None = None, spec: PanelSpec = PANEL, size: int = DEFAULT_SLAB) -> DataFrame:
    """Teacher-forced evaluation of any scorer: every origin sees the true history, in one plan."""
    scored = scorer(origin_windows(df, context, first, every, spec, size))
    return scored.select(spec.entity, spec.ts, spec.idx, spec.y, "origin_idx", "lead", "pred")


# --- scorers --------------------------------------------------------------------------------

def fit_linear(rows: DataFrame, features: Sequence[str], label: str) -> tuple[dict[str, float], float]:
    """Least squares with intercept over complete rows: coefficients and intercept.

    One aggregation of means and covariances; ``(p + 1) * (p + 4) / 2`` numbers reach the driver.
    """
    names = [*features, label]
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    got = rows.dropna(subset=names).agg(
        *[F.avg(n).alias(f"m{i}") for i, n in enumerate(names)],
        *[F.covar_pop(names[i], names[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    if got["m0"] is None:
        raise ValueError("no complete row to fit")
    p = len(features)
    cov = np.array([[got[f"c{min(i, j)}_{max(i, j)}"] for j in range(p + 1)] for i in range(p + 1)], float)
    weights = np.linalg.lstsq(cov[:p, :p], cov[:p, p], rcond=None)[0]
    intercept = got[f"m{p}"] - sum(w * got[f"m{i}"] for i, w in enumerate(weights))
    return dict(zip(features, map(float, weights))), float(intercept)


def linear_origins(coefficients: Mapping[str, float], intercept: float, lags: Sequence[int],
                   spec: PanelSpec = PANEL) -> OriginScorer:
    """Fitted linear model over lags and future-known columns; predictions are not negative."""
    def run(windows: DataFrame) -> DataFrame:
        value = F.lit(float(intercept))
        for name, weight in coefficients.items():
            value = value + F.lit(float(weight)) * F.col(name)
        return lead_rows(windows, lags, spec).withColumn("pred", clip(value))
    return run


def model_origins(predict: Callable[[DataFrame], DataFrame], lags: Sequence[int], spec: PanelSpec = PANEL) -> OriginScorer:
    """A fitted row model: ``predict`` adds ``pred`` to rows with the features of :func:`lead_rows`."""
    def run(windows: DataFrame) -> DataFrame:
        return predict(lead_rows(windows, lags, spec))
    return run


def batch_origins(predict: Callable[[np.ndarray, dict[str, np.ndarray]], np.ndarray], every: int | None = None,
                  spec: PanelSpec = PANEL) -> OriginScorer:
    """A sequence model: ``predict(contexts, covariates)`` gives one row of ``every`` values per row of contexts.

    Contexts and covariates are matrices with NaN where nothing is known; covariates are the ``past_`` and ``ahead_``
    columns by name.  It is shipped to the tasks and called on Arrow batches.
    """
    every = every or spec.horizon

    def run(windows: DataFrame) -> DataFrame:
        extra = [f"past_{c}" for c in spec.past_only] + [f"ahead_{c}" for c in spec.known_future]
        keep = [c for c in windows.columns if c not in ("context", *[f"past_{c}" for c in spec.past_only])]

        def matrix(batch: pa.RecordBatch, c: str) -> np.ndarray:
            values = batch.column(c).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
            return values.reshape(batch.num_rows, -1)

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    values = predict(matrix(batch, "context"), {c: matrix(batch, c) for c in extra})
                    rows = pa.array(list(np.asarray(values, float)[:, :every]), pa.list_(pa.float64()))
                    yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], rows], names=[*keep, "_pred"])

        schema = windows.select(*keep, F.lit(None).cast("array<double>").alias("_pred")).schema
        return lead_rows(windows.mapInArrow(score, schema), (), spec, F.col("_pred"))
    return run
