"""Forecast production: baselines, rolling and recursive evaluation, export."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import add_steps
from ..plans.coding import dense_codes
from ..plans.lineage import staged
from ..plans.slabs import DEFAULT_SLAB
from ..spec import LAG_HOURS, PANEL, PRICE_COLUMNS, ROLL_WINDOWS, PanelSpec
from .clean import clip, last_rows
from .features import lag_columns, lag_features
from .grid import spine
from .stats import growth_factor, prior_month_template

Scorer = Callable[[DataFrame], DataFrame]


def monthly_baseline(df: DataFrame, target_month: str, spec: PanelSpec = PANEL,
                     prices: Sequence[str] = PRICE_COLUMNS, with_actuals: bool = True) -> DataFrame:
    """Last month's day-and-hour profile times last year's growth, with actuals attached.

    ``target_month`` is the first day of the month (yyyy-MM-01).  Incomplete rows are dropped.
    """
    start = F.lit(target_month).cast("timestamp_ntz")
    end = F.last_day(F.lit(target_month).cast("date")).cast("timestamp_ntz") + F.expr(
        "interval 23 hours")
    grid = spine(df.filter(F.col(spec.entity).isNotNull()), start, end, spec).withColumn(
        "day", F.dayofmonth(spec.ts)).withColumn("hour", F.hour(spec.ts))
    out = (grid.join(prior_month_template(df, target_month, spec), [spec.entity, "day", "hour"])
           .join(growth_factor(df, target_month, spec), spec.entity, "left")
           .withColumn("growth", F.when(F.col("growth").isNull(), 1.0).otherwise(F.col("growth")))
           .withColumn("pred", F.col("template") * F.col("growth")))
    columns = [*spec.key, "template", "growth", "pred"]
    if with_actuals:
        inside = (F.col(spec.ts) >= start) & (F.col(spec.ts) <= end)
        actual = df.filter(inside).select(*spec.key, spec.y, *prices)
        out = out.join(actual, spec.key)
        columns += [spec.y, *prices]
    return out.select(*columns).dropna()


def seasonal_lag(df: DataFrame, lag: int, spec: PanelSpec = PANEL, size: int = DEFAULT_SLAB,
                 output: str = "pred") -> DataFrame:
    """The value ``lag`` steps ago as the forecast."""
    return lag_columns(df, [lag], spec, size).withColumnRenamed(f"lag_{lag}", output)


def rolling_origins(df: DataFrame, first: int | Column, every: int | None = None,
                    spec: PanelSpec = PANEL) -> DataFrame:
    """Forecast origin and lead (1 = first step after the origin) of each evaluated row."""
    every = every or spec.horizon
    first = F.lit(first) if isinstance(first, int) else first
    step = F.col(spec.idx) - first
    origin = first + F.floor(step / every) * every - 1
    return (df.filter(step >= 0).withColumn("origin_idx", origin.cast("long"))
            .withColumn("lead", (F.col(spec.idx) - F.col("origin_idx")).cast("long")))


def rolling_seasonal(df: DataFrame, first: int | Column, period: int = 24,
                     every: int | None = None, spec: PanelSpec = PANEL,
                     size: int = DEFAULT_SLAB) -> DataFrame:
    """Teacher-forced evaluation of the seasonal scorer.

    Every origin sees the true history; origins are independent, so all of them are one
    plan.  A row uses the latest value of its phase known at its origin.
    """
    every = every or spec.horizon
    cycles = range(1, -(-every // period) + 1)
    lagged = lag_columns(df, [period * c for c in cycles], spec, size)
    placed = rolling_origins(lagged, first, every, spec)
    need = F.ceil(F.col("lead") / period)
    pred = F.coalesce(*[F.when(need == c, F.col(f"lag_{period * c}")) for c in cycles])
    return placed.select(*df.columns, "origin_idx", "lead", pred.alias("pred"))


def dedupe_forecasts(df: DataFrame, keep: str = "last", spec: PanelSpec = PANEL,
                     origin: str = "origin_idx") -> DataFrame:
    """One forecast per (entity, step): ``first`` = longest lead, ``last`` = newest origin."""
    pick = {"first": F.min_by, "last": F.max_by}[keep]
    rest = [c for c in df.columns if c not in (spec.entity, spec.idx, origin)]
    end = F.min if keep == "first" else F.max
    return df.groupBy(spec.entity, spec.idx).agg(end(origin).alias(origin),
                                                 *[pick(c, origin).alias(c) for c in rest])


def seed_history(df: DataFrame, length: int, spec: PanelSpec = PANEL, policy: str = "pad") -> DataFrame:
    """Entities with a short history: ``skip`` them, or ``pad`` in front with their mean."""
    facts = df.groupBy(spec.entity).agg(F.count(spec.y).alias("_n"), F.avg(spec.y).alias("_m"),
                                        F.min(spec.idx).alias("_a"), F.min(spec.ts).alias("_t"))
    if policy == "skip":
        return df.join(facts.filter(F.col("_n") >= length).select(spec.entity), spec.entity,
                       "left_semi")
    short = facts.filter((F.col("_n") < length) & (F.col("_n") > 0)).select(
        "*", F.explode(F.sequence(F.lit(1), (F.lit(length) - F.col("_n")).cast("int"))).alias("_k"))
    pad = short.select(spec.entity, add_steps(F.col("_t"), -F.col("_k"), spec.step_seconds)
                       .alias(spec.ts), (F.col("_a") - F.col("_k")).alias(spec.idx),
                       F.col("_m").alias(spec.y))
    return df.unionByName(pad, allowMissingColumns=True)


# --- scoring with fitted models ---------------------------------------------------------

def linear_scorer(coefficients: Mapping[str, float], intercept: float = 0.0,
                  spec: PanelSpec = PANEL, lags: Sequence[int] = LAG_HOURS,
                  windows: Sequence[int] = ROLL_WINDOWS, diffs: Sequence[int] = (48, 168),
                  size: int = DEFAULT_SLAB) -> Scorer:
    """Scorer over lag features: rows with unknown target get a clipped linear prediction."""
    def run(panel: DataFrame) -> DataFrame:
        rich = lag_features(panel, spec, lags, windows, diffs, size)
        value = F.lit(float(intercept))
        for name, weight in coefficients.items():
            value = value + F.lit(float(weight)) * F.col(name)
        return rich.filter(F.col(spec.y).isNull()).select(*panel.columns, clip(value).alias("pred"))
    return run


def recursive_forecast(history: DataFrame, future: DataFrame, scorer: Scorer, horizon: int | None,
                       context: int, spec: PanelSpec = PANEL, chunk: int | None = None) -> DataFrame:
    """Multi-step forecast by chunks; predictions become history of the next chunk.

    ``future`` holds (entity, ts, index, covariates); ``horizon`` None means all of its steps.  With features
    that look back at least ``chunk`` steps each chunk is one plan, whatever the number of
    entities.  Entities may end at different steps.

    The state between chunks is a table: one write holds a chunk's scores and the last ``context`` rows of each
    entity, and the next chunk reads that file and its own part of the future.  So every step is scored once, the plan
    of a chunk is the same for all chunks, and a lost executor replays one chunk.
    """
    chunk = chunk or spec.horizon
    last = history.groupBy(spec.entity).agg(F.max(spec.idx).alias("_b"))
    steps = future.join(last, spec.entity).withColumn("_lead", F.col(spec.idx) - F.col("_b")).filter("_lead >= 1").drop("_b")
    if horizon is not None:
        steps = steps.filter(F.col("_lead") <= horizon)
    steps = steps.withColumn("_chunk", F.floor((F.col("_lead") - 1) / chunk).cast("int")).drop("_lead")
    steps = staged(steps.withColumn(spec.y, F.lit(None).cast("double")), "future-steps", "_chunk")
    state = staged(last_rows(history, context, spec, spec.idx), "forecast-state")
    tables = []
    final = steps.agg(F.max("_chunk")).first()[0] or 0
    for number in range(final + 1):
        ahead = steps.filter(F.col("_chunk") == number).drop("_chunk")
        state = _next_state(state, ahead, scorer, context, spec)
        tables.append(state)
        state = state.filter("_state").drop("_scored", "_state")
    fresh = [t.filter("_scored").drop("_scored", "_state").withColumn("pred", F.col(spec.y)).withColumn(
        spec.y, F.lit(None).cast("double")) for t in tables]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), fresh)


def _next_state(state: DataFrame, ahead: DataFrame, scorer: Scorer, context: int, spec: PanelSpec) -> DataFrame:
    """Written once: the scored steps (``_scored``) and the rows that the next chunk looks back on (``_state``)."""
    scored = scorer(state.unionByName(ahead, allowMissingColumns=True))
    known = scored.withColumn(spec.y, F.col("pred")).drop("pred").withColumn("_scored", F.lit(True))
    every = state.withColumn("_scored", F.lit(False)).unionByName(known, allowMissingColumns=True)
    back = Window.partitionBy(spec.entity).orderBy(F.col(spec.idx).desc())
    rank = F.row_number().over(back)
    return staged(every.withColumn("_state", rank <= context).filter("_state OR _scored"), "forecast-state")


def bucket_index(df: DataFrame, per_bucket: int = 110, spec: PanelSpec = PANEL) -> DataFrame:
    """Entities in order, ``per_bucket`` to a bucket, with the bucket's label."""
    codes = dense_codes(df, spec.entity, "_c")
    bucket = F.floor(F.col("_c") / per_bucket).cast("int")
    total = codes.agg(F.max("_c") + 1).scalar()
    first = bucket * per_bucket + 1
    label = F.concat(F.lit("EIC "), first.cast("string"), F.lit("–"),
                     F.least(first + (per_bucket - 1), total).cast("string"))
    return codes.select(spec.entity, bucket.alias("bucket"), label.alias("label"))


def export_buckets(df: DataFrame, path: str, per_bucket: int = 110,
                   spec: PanelSpec = PANEL) -> DataFrame:
    """Write forecasts partitioned by bucket; returns the index of entities."""
    index = bucket_index(df, per_bucket, spec)
    (df.join(index.select(spec.entity, "bucket"), spec.entity)
     .write.mode("overwrite").partitionBy("bucket").parquet(path))
    return index
