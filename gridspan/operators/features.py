"""Lag, rolling, window and decomposition features on a regular panel.

All features expect a complete grid (``grid.full_grid``): one row per step, NULL where the
value is unknown.  Row offsets are then step offsets.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.slabs import (DEFAULT_SLAB, SLAB, on_slabs, rejoin, settle, slab_arrays, slab_of, slab_window,
                           spread)
from ..spec import LAG_HOURS, PANEL, ROLL_WINDOWS, PanelSpec
from .clean import group_values, last_rows
from .grid import grid_of


def lag_features(df: DataFrame, spec: PanelSpec = PANEL, lags: Sequence[int] = LAG_HOURS,
                 windows: Sequence[int] = ROLL_WINDOWS, diffs: Sequence[int] = (48, 168),
                 size: int = DEFAULT_SLAB) -> DataFrame:
    """Lags, leakage-safe rolling means/deviations and seasonal differences.

    Rolling frames end ``horizon`` steps before the row and need a quarter of their rows.
    All columns share one window ordering, hence one shuffle and one sort.  A long window is
    merged from blocks as long as the greatest common divisor of all windows (count, mean
    and squared deviation of each), so a row costs one short frame instead of every frame.
    """
    h = spec.horizon
    reach = max([h, *lags, *[h + n for n in windows], *[h + d for d in diffs]])
    w = slab_window([spec.entity], spec.idx)

    def back(c: str, k: int) -> Column:
        return F.lag(c, k).over(w)

    near = spread(df, spec.idx, reach, 0, size)
    block = math.gcd(*windows) if windows else 0
    out = [back(spec.y, k).alias(f"lag_{k}h") for k in lags]
    out += [(back(spec.y, h) - back(spec.y, h + d)).alias(f"diff_{d}h") for d in diffs]
    if windows:
        frame = w.rowsBetween(-(block - 1), 0)
        n = F.count(spec.y).over(frame)
        near = near.select("*", n.alias("_n"), F.avg(spec.y).over(frame).alias("_m"),
                           (F.var_pop(spec.y).over(frame) * n).alias("_q"))
        starts = range(h, h + max(windows), block)
        out += [F.coalesce(back(f"_{x}", k), F.lit(0)).alias(f"_{x}{k}") for k in starts for x in "nmq"]
    near = settle(near.select("*", *out), spec.idx, size)

    means, stds = [], []
    for n in windows:
        parts = [(F.col(f"_n{k}"), F.col(f"_m{k}"), F.col(f"_q{k}")) for k in range(h, h + n, block)]
        count = _total(c for c, _, _ in parts)
        means.append(F.when(count >= max(1, n // 4), _total(c * m for c, m, _ in parts) / count)
                     .alias(f"roll_mean_{n}h"))
        mean = F.col(f"roll_mean_{n}h")
        square = _total(q + c * (m - mean) * (m - mean) for c, m, q in parts)
        stds.append(F.when(mean.isNotNull() & (count > 1), F.sqrt(square / (count - 1)))
                    .alias(f"roll_std_{n}h"))
    rolled = near.select("*", *means).select("*", *stds)
    return rolled.select(*df.columns, *[f"lag_{k}h" for k in lags],
                         *[f"roll_{s}_{n}h" for n in windows for s in ("mean", "std")],
                         *[f"diff_{d}h" for d in diffs])


def _total(columns) -> Column:
    first, *rest = columns
    return sum(rest, first)


def lag_columns(df: DataFrame, lags: Sequence[int], spec: PanelSpec = PANEL,
                size: int = DEFAULT_SLAB, column: str | None = None,
                prefix: str = "lag_") -> DataFrame:
    w = slab_window([spec.entity], spec.idx)
    near = spread(df, spec.idx, max(lags), 0, size)
    return settle(near.select("*", *[F.lag(column or spec.y, k).over(w).alias(f"{prefix}{k}")
                                     for k in lags]), spec.idx, size)


def outage_flag(df: DataFrame, spec: PanelSpec = PANEL, minimum: int = 30, share: float = 0.25,
                keep_stats: bool = False) -> DataFrame:
    """1 where the load is far below the median of its weekday and hour.

    A (entity, weekday, hour) group of a unique hourly panel has one row a week.
    """
    slots = df.select("*", F.weekday(spec.ts).alias("_dow"), F.hour(spec.ts).alias("_hour"))
    out = group_values(slots, [spec.entity, "_dow", "_hour"],
                       median_y=F.median(spec.y), count_y=F.count(spec.y))
    low = (F.col("count_y") >= minimum) & (F.col(spec.y) < F.lit(share) * F.col("median_y"))
    out = out.withColumn("outage", F.when(low, 1).otherwise(0)).drop("_dow", "_hour")
    return out if keep_stats else out.drop("median_y", "count_y")


# --- window samples -------------------------------------------------------------------

def window_starts(df: DataFrame, context: int, horizon: int, stride: int | None = None,
                  spec: PanelSpec = PANEL, holdout: int = 0, tail_only: bool = False) -> DataFrame:
    """First index of every window sample of an entity.

    Starts go from the first step in strides while the window ends before the held-out
    tail; ``tail_only`` gives the single last window.  Entities too short give none.
    """
    span, stride = context + horizon, stride or horizon
    ends = df.groupBy(spec.entity).agg(F.min(spec.idx).alias("_a"), F.max(spec.idx).alias("_b"))
    if tail_only:
        return (ends.filter(F.col("_b") - F.col("_a") + 1 >= span)
                .select(spec.entity, (F.col("_b") - span + 1).alias("start_idx")))
    room = F.col("_b") - F.col("_a") + 1 - span - holdout
    numbered = grid_of(ends.filter(room >= 0).select(
        spec.entity, "_a", F.lit(0).cast("long").alias("_from"),
        F.floor(room / stride).cast("long").alias("_to")),
        "_from", "_to", spec.with_(idx="_n"))
    return numbered.select(spec.entity, (F.col("_a") + F.col("_n") * stride).alias("start_idx"))


def sample_starts(starts: DataFrame, n: int, seed: int = 42, spec: PanelSpec = PANEL) -> DataFrame:
    """``n`` starts per entity by a seeded hash."""
    w = Window.partitionBy(spec.entity).orderBy(
        F.xxhash64(spec.entity, "start_idx", F.lit(seed)), "start_idx")
    return starts.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n).drop("_r")


def window_samples(df: DataFrame, starts: DataFrame, context: int, horizon: int,
                   spec: PanelSpec = PANEL, size: int = DEFAULT_SLAB) -> DataFrame:
    """One row per start with arrays: ``context`` and ``target`` of the target column,
    ``past_<c>`` of past-only columns, ``all_<c>`` of future-known ones, statics as values.

    Rows are gathered once per slab with the window's length as halo, and every window of the slab is a slice of
    that array, so the shuffle does not grow with the number of overlapping windows.  Windows over an absent step are
    left out.
    """
    span = context + horizon
    used = list(dict.fromkeys([spec.y, *spec.past_only, *spec.known_future, *spec.static]))
    near = slab_arrays(df, [spec.entity], spec.idx, used, 0, span, size)
    home = starts.select(spec.entity, "start_idx", slab_of("start_idx", size).alias(SLAB))
    rows = F.col("_rows")
    joined = home.join(near, [spec.entity, SLAB]).withColumn(
        "_at", F.array_position(rows.getField(spec.idx), F.col("start_idx")).cast("int"))
    last = F.get(rows.getField(spec.idx), F.col("_at") + (span - 2))
    whole = joined.filter((F.col("_at") > 0) & (last == F.col("start_idx") + (span - 1)))

    def part(c: str, first: int, n: int) -> Column:
        return F.slice(rows.getField(c), F.col("_at") + (first - 1), F.lit(n))

    out = [part(spec.y, 1, context).alias("context"),
           part(spec.y, context + 1, horizon).alias("target")]
    out += [part(c, 1, context).alias(f"past_{c}") for c in spec.past_only]
    out += [part(c, 1, span).alias(f"all_{c}") for c in spec.known_future]
    return whole.select(spec.entity, "start_idx", (F.col("start_idx") + context).alias("origin_idx"), *out,
                        *[F.get(rows.getField(c), F.col("_at") - 1).alias(c) for c in spec.static])


def patches(values: str | Column, patch: int, width: int | None = None) -> Column:
    """An array cut into patches, each padded with zeros to ``width``."""
    values = F.col(values) if isinstance(values, str) else values
    pad = F.array_repeat(F.lit(0.0), (width or patch) - patch)
    count = F.floor(F.size(values) / patch).cast("int")
    return F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.concat(
        F.slice(values, i * patch + 1, F.lit(patch)), pad))


def patch_masks(context: int, horizon: int, patch: int, width: int) -> tuple[Column, Column]:
    """(observed mask of one patch, prediction mask over patches)."""
    n, ahead = (context + horizon) // patch, horizon // patch
    observed = F.concat(F.array_repeat(F.lit(True), patch), F.array_repeat(F.lit(False), width - patch))
    predicted = F.concat(F.array_repeat(F.lit(False), n - ahead), F.array_repeat(F.lit(True), ahead))
    return observed, predicted


def array_mean(values: str | Column) -> Column:
    values = F.col(values) if isinstance(values, str) else values
    known = F.filter(values, lambda v: v.isNotNull())
    total = F.aggregate(known, F.lit(0.0), lambda a, v: a + v.cast("double"))
    return total / F.nullif(F.size(known), F.lit(0))


def array_std(values: str | Column) -> Column:
    """Population standard deviation of an array."""
    values = F.col(values) if isinstance(values, str) else values
    m = array_mean(values)
    return F.sqrt(array_mean(F.transform(values, lambda v: (v - m) * (v - m))))


def normalise_windows(windows: DataFrame, floor: float = 1e-5) -> DataFrame:
    """Scale ``context`` and ``target`` by the context's own mean and deviation; both are kept."""
    stats = windows.withColumn("norm_mean", array_mean("context")).withColumn(
        "norm_std", F.greatest(array_std("context"), F.lit(floor)))
    scale = lambda v: (v - F.col("norm_mean")) / F.col("norm_std")
    return stats.withColumn("context", F.transform("context", scale)).withColumn(
        "target", F.transform("target", scale))


def denormalise(values: str, mean: str = "norm_mean", std: str = "norm_std") -> Column:
    return F.transform(values, lambda v: v * F.col(std) + F.col(mean))


def mean_abs_scale(values: str | Column) -> Column:
    """Mean of absolute values of an array, 1 where it is 0 or unknown."""
    values = F.col(values) if isinstance(values, str) else values
    m = array_mean(F.transform(values, lambda v: F.abs(v)))
    return F.when(m > 0, m).otherwise(F.lit(1.0))


def position_covariates(df: DataFrame, context: int, spec: PanelSpec = PANEL, size: int = DEFAULT_SLAB) -> DataFrame:
    """Position in the series, history available to a row (at most ``context``), and the
    target's mean and deviation as columns."""
    out = group_values(df, [spec.entity], slab_of(spec.idx, size), _a=F.min(spec.idx), y_center=F.avg(spec.y),
                       y_scale=F.stddev_samp(spec.y))
    pos = F.col(spec.idx) - F.col("_a")
    return out.withColumn("rel_idx", pos).withColumn(
        "history", F.least(pos, F.lit(context))).drop("_a")


# --- decomposition ----------------------------------------------------------------------

def decompose(df: DataFrame, spec: PanelSpec = PANEL, period: int = 24,
              size: int = DEFAULT_SLAB) -> DataFrame:
    """Additive decomposition with an even period: trend, seasonal and residual.

    Trend is the centred moving average with half weights at both ends, NULL where its
    window is incomplete; the seasonal part is the centred mean of the detrended phases.
    """
    half = period // 2
    w = slab_window([spec.entity], spec.idx)
    frame = w.rowsBetween(-half, half)
    ends = F.lag(spec.y, half).over(w) + F.lead(spec.y, half).over(w)
    full = F.count(spec.y).over(frame) == period + 1
    near = spread(df, spec.idx, half, half, size)
    trend = settle(near.withColumn(
        "trend", F.when(full, (F.sum(spec.y).over(frame) - ends / 2) / period)), spec.idx, size)
    # The pattern by the index's own phase; the first index then tells where the entity's phases begin.
    clock = F.pmod(F.col(spec.idx), F.lit(period)).cast("int")
    pattern = seasonal_pattern(trend.withColumn("phase", clock), spec, period)
    shape = F.map_from_entries(F.collect_list(F.struct("phase", "seasonal"))).alias("_shape")
    first = df.groupBy(spec.entity).agg(F.min(spec.idx).alias("_a"))
    facts = rejoin(first, pattern.groupBy(spec.entity).agg(shape), [spec.entity])
    joined = on_slabs(trend, facts, [spec.entity], slab_of(spec.idx, size))
    seasonal = F.try_element_at("_shape", clock)
    return joined.select(
        *df.columns, ((F.col(spec.idx) - F.col("_a")) % period).cast("int").alias("phase"), "trend",
        seasonal.alias("seasonal"), (F.col(spec.y) - F.col("trend") - seasonal).alias("resid"))


def seasonal_pattern(phased: DataFrame, spec: PanelSpec = PANEL, period: int = 24) -> DataFrame:
    """Centred phase means of the detrended series, one row per (entity, phase)."""
    means = phased.groupBy(spec.entity, "phase").agg(F.avg(F.col(spec.y) - F.col("trend")).alias("_m"))
    every = Window.partitionBy(spec.entity)  # at most `period` rows
    return means.select(spec.entity, "phase", (F.col("_m") - F.avg("_m").over(every)).alias("seasonal"))


def trend_line(decomposed: DataFrame, horizon: int, spec: PanelSpec = PANEL,
               tail: int = 24 * 14, drift: float = 0.2) -> DataFrame:
    """Last trend value and robust slope per entity.

    The slope is the median step of the last ``tail`` trend values, capped so that the whole
    horizon moves the level by at most ``drift``.
    """
    known = decomposed.filter(F.col("trend").isNotNull()).select(spec.entity, spec.idx, "trend")
    recent = last_rows(known, tail, spec, spec.idx)
    w = Window.partitionBy(spec.entity).orderBy(spec.idx)  # at most `tail` rows
    steps = recent.withColumn("_d", F.col("trend") - F.lag("trend").over(w))
    line = steps.groupBy(spec.entity).agg(F.max_by("trend", spec.idx).alias("level"),
                                          F.coalesce(F.median("_d"), F.lit(0.0)).alias("_s"))
    cap = F.lit(drift) * F.abs("level") / max(horizon, 1)
    slope = F.when(F.col("level") == 0, F.col("_s")).otherwise(
        F.greatest(-cap, F.least(F.col("_s"), cap)))
    return line.select(spec.entity, "level", slope.alias("slope"))


def recompose(decomposed: DataFrame, horizon: int, spec: PanelSpec = PANEL, period: int = 24,
              residual: DataFrame | None = None, bound: float = 5.0) -> DataFrame:
    """Forecast = extrapolated trend + tiled season (+ residual forecast), clipped.

    ``residual`` has (entity, step, resid_pred) with step 1 the first hour after the series;
    further columns (such as a candidate's id) pass through.  A series too short for a trend
    stays at its mean (0 without a known value), and a phase without a seasonal value adds nothing.
    """
    facts = decomposed.groupBy(spec.entity).agg(
        F.max(spec.idx).alias("_b"), F.max(spec.ts).alias("_ts"), F.max(spec.y).alias("_top"),
        F.avg(spec.y).alias("_mean"), (F.max(spec.idx) - F.min(spec.idx) + 1).alias("_n"))
    pattern = decomposed.groupBy(spec.entity, "phase").agg(F.first("seasonal", True).alias("seasonal"))
    ahead = (rejoin(facts, trend_line(decomposed, horizon, spec), [spec.entity])
             .withColumn("level", F.coalesce("level", "_mean", F.lit(0.0)))
             .withColumn("slope", F.coalesce("slope", F.lit(0.0)))
             .select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
             .withColumn("phase", ((F.col("_n") + F.col("step") - 1) % period).cast("int")))
    future = rejoin(ahead, pattern, [spec.entity, "phase"]).withColumn("seasonal", F.coalesce("seasonal", F.lit(0.0)))
    resid, extra = F.lit(0.0), []
    if residual is not None:
        future = rejoin(future, residual, [spec.entity, "step"])
        extra = [c for c in residual.columns if c not in (spec.entity, "step", "resid_pred")]
        resid = F.coalesce("resid_pred", F.lit(0.0))
    raw = resid + F.col("level") + F.col("slope") * F.col("step") + F.col("seasonal")
    upper = F.when(F.col("_top") > 0, F.lit(bound) * F.col("_top"))
    ts = F.col("_ts") + F.make_dt_interval(secs=F.col("step") * spec.step_seconds)
    return future.select(spec.entity, (F.col("_b") + F.col("step")).alias(spec.idx),
                         ts.alias(spec.ts), "step", *extra,
                         F.greatest(F.lit(0.0), F.least(raw, upper)).alias("pred"))
