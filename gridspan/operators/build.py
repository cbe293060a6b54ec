"""From landed readings to silver and gold tables, and from a history to a forecast frame.

Each step is an operator of this package.  Steps that read their input more than once
(coverage, gaps, fills) would multiply one long plan, so the build is cut at four stages.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import calendar_fields
from ..functions.timezone import to_local, to_utc
from ..plans.lineage import cut
from ..plans.slabs import DEFAULT_SLAB
from ..spec import PANEL, PRICE_COLUMNS, TRAIN_END, VAL_END, PanelSpec
from . import clean as K
from . import grid as G
from . import joins as J

Stage = Callable[[DataFrame, str], DataFrame]


def materialise(df: DataFrame, name: str) -> DataFrame:
    """The default stage: written to the shared folder and read back."""
    return cut(df)


@dataclass(frozen=True)
class Sources:
    """Frames a build reads.  Only readings and stations are required.

    stations: entity, latitude, longitude and attributes; solar: entity, since, power (one
    row per entity); chargers: entity, since, power (many); capacity: entity, max_power;
    rules: see ``clean.rules_frame``; weather: ts, latitude, longitude, variables; prices:
    ts and the three price columns.
    """

    readings: DataFrame
    stations: DataFrame
    patch: DataFrame | None = None
    solar: DataFrame | None = None
    chargers: DataFrame | None = None
    capacity: DataFrame | None = None
    rules: DataFrame | None = None
    weather: DataFrame | None = None
    prices: DataFrame | None = None
    weather_columns: Sequence[str] = ()


@dataclass(frozen=True)
class BuildOptions:
    zone: str | None = None
    ambiguous: str = "earliest"
    tail_days: int = 7
    min_rows: int = 90 * 24
    max_missing: int = 3
    min_days: int = 90
    max_gap: int = 1
    train_end: str = TRAIN_END
    val_end: str = VAL_END
    size: int = DEFAULT_SLAB
    spec: PanelSpec = field(default_factory=lambda: PANEL)


def conform(src: Sources, opt: BuildOptions) -> DataFrame:
    """Unique (entity, hour) readings in UTC; copies keep the largest value."""
    spec, df = opt.spec, opt.spec.require(src.readings)
    if opt.zone:
        df = df.withColumn(spec.ts, to_utc(spec.ts, opt.zone, opt.ambiguous))
    return df.filter(F.col(spec.ts).isNotNull()).groupBy(
        spec.entity, F.date_trunc("hour", spec.ts).alias(spec.ts)).agg(F.max(spec.y).alias(spec.y))


def describe(df: DataFrame, src: Sources, opt: BuildOptions) -> DataFrame:
    """Station attributes, solar and connected capacity, then the rules.

    A missing capacity is the largest reading before the rules cut any.
    """
    spec, stations = opt.spec, src.stations
    if src.patch is not None:
        stations = K.patch_missing(stations, src.patch, spec.entity, ["latitude", "longitude"])
    df = J.with_dimension(df, stations, [spec.entity])
    if src.solar is not None:
        df = _on_local_clock(df, opt, lambda local: J.effective_value(
            local, src.solar, "since", "power", spec, "max_solar"))
    if src.capacity is not None:
        df = K.fill_by_group_max(J.with_dimension(df, src.capacity, [spec.entity]), "max_power", spec,
                                 size=opt.size)
    if src.rules is not None:
        df = _on_local_clock(df, opt, lambda local: K.apply_rules(local, src.rules, spec))
    return df


def _on_local_clock(df: DataFrame, opt: BuildOptions, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work`` on stamps of the build's zone, in which dated facts and rules are given; UTC before and after."""
    if not opt.zone:
        return work(df)
    ts = opt.spec.ts
    local = df.withColumnRenamed(ts, "_utc").withColumn(ts, to_local("_utc", opt.zone))
    return work(local).drop(ts).withColumnRenamed("_utc", ts)


def surround(df: DataFrame, src: Sources, opt: BuildOptions) -> DataFrame:
    """Weather and charger capacity."""
    spec = opt.spec
    if src.weather is not None:
        df = J.fill_weather(df, src.weather, src.weather_columns, spec)
    if src.chargers is not None:
        df = _on_local_clock(df, opt, lambda local: J.effective_sum(
            local, src.chargers, "since", "power", spec, "max_ev"))
    return df


def repair(df: DataFrame, opt: BuildOptions, static: Sequence[str], numeric: Sequence[str],
           stage: Stage = materialise) -> DataFrame:
    """Drop entities with long gaps, complete the grid, fill statics, interpolate numbers; the
    index counts from the first stamp left."""
    spec = opt.spec
    bad = G.longest_gaps(df, spec, opt.max_gap, opt.size).filter("action = 'DROP'").select(spec.entity)
    full = G.full_grid(df.join(bad, spec.entity, "left_anti"), spec, opt.size)
    known = [c for c in static if c in full.columns]
    numbers = [c for c in numeric if c in full.columns]
    if known:
        values = df.groupBy(spec.entity).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(spec.ts)))
                                               .alias(c) for c in known])
        full = full.drop(*known).join(values, spec.entity)
    full = stage(full, "grid")
    return G.interpolate(G.index_from(full, spec=spec), numbers, spec, size=opt.size)


def build_silver(src: Sources, opt: BuildOptions | None = None,
                 stage: Stage = materialise) -> DataFrame:
    """Readings to a regular, enriched, split panel.

    ``stage`` gets the frame and a name (conformed,
    enriched, trimmed, grid, prices) and returns the frame to
    go on with; pass a writer to keep the stages as tables.
    """
    opt = opt or BuildOptions()
    spec = opt.spec
    df = describe(stage(conform(src, opt), "conformed"), src, opt)
    df = K.keep_covered(df, spec, opt.tail_days, opt.min_rows)
    df = stage(surround(df, src, opt), "enriched")
    df = G.index_from(df, spec=spec)
    df = stage(G.trim_to_tail(df, spec, opt.max_missing, opt.min_days, opt.size), "trimmed")
    static = [c for c in src.stations.columns if c != spec.entity]
    numeric = [spec.y, "max_power", "max_solar", "max_ev", *src.weather_columns]
    df = repair(df, opt, static, numeric, stage)
    if src.prices is not None:
        filled = G.complete_time_table(src.prices, spec.with_(idx="_i"), PRICE_COLUMNS, opt.size)
        df = J.with_prices(df, stage(filled.drop("_i"), "prices"), spec)
    df = df.select("*", *[e.alias(n) for n, e in calendar_fields(spec.ts).items()])
    return G.label_splits(df, opt.train_end, opt.val_end, spec)


def inference_frame(src: Sources, start: str, end: str, opt: BuildOptions | None = None) -> DataFrame:
    """History and the forecast window on one grid, enriched alike; the target is NULL on the
    window.  ``start`` must not precede the history."""
    opt = opt or BuildOptions()
    spec = opt.spec
    grid = G.extend(conform(src, opt), start, end, spec)
    df = G.index_from(surround(describe(grid, src, opt), src, opt), spec=spec)
    if src.prices is not None:
        df = J.with_prices(df, src.prices, spec)
    return df.select("*", *[e.alias(n) for n, e in calendar_fields(spec.ts).items()])


def forecast_window(frame: DataFrame, score: Callable[[DataFrame], DataFrame], start: str, end: str,
                    spec: PanelSpec = PANEL, prices: Sequence[str] = PRICE_COLUMNS) -> DataFrame:
    """Score the unknown rows of the window and return keys, prediction and prices."""
    pred = score(frame).select(*spec.key, "pred")
    wanted = K.between(K.to_forecast(frame, spec), start, end, spec=spec)
    return wanted.select(*spec.key, *[c for c in prices if c in frame.columns]).join(pred, spec.key)
