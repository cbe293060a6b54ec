"""The time grid of a panel: index, gaps, trimming, completion and filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import add_steps, hour_index
from ..plans.slabs import (DEFAULT_SLAB, SLAB, neighbours, on_slabs, previous_index, rejoin, settle, slab_of,
                           slab_window, spread, time_slab)
from ..spec import PANEL, PanelSpec
from .clean import group_values, last_rows


def index_from(df: DataFrame, origin: Column | str | None = None,
               spec: PanelSpec = PANEL) -> DataFrame:
    """Step index from a fixed origin, or from the first stamp of the whole frame."""
    if origin is None:
        origin = df.agg(F.min(spec.ts).alias("_o")).scalar()
    elif isinstance(origin, str):
        origin = F.lit(origin)
    return df.withColumn(spec.idx, hour_index(spec.ts, origin, spec.step_seconds))


def index_by_entity(df: DataFrame, spec: PanelSpec = PANEL) -> DataFrame:
    """Step index from the entity's own first stamp."""
    out = group_values(df, [spec.entity], time_slab(spec.ts, spec.step_seconds), _first=F.min(spec.ts))
    return out.withColumn(spec.idx, hour_index(spec.ts, F.col("_first"), spec.step_seconds)
                          ).drop("_first")


def hourly_sum(df: DataFrame, value: str, spec: PanelSpec = PANEL,
               unit: str = "hour") -> DataFrame:
    """Readings of any density to one row per entity and step (map-side combined)."""
    return (df.groupBy(F.col(spec.entity), F.date_trunc(unit, F.col(spec.ts)).alias(spec.ts))
            .agg(F.sum(value).alias(spec.y)))


def deduplicate(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                keep: str = "first") -> DataFrame:
    """One row per key by an explicit order (ties must be broken by the order).

    Rank 1 is filtered before the shuffle as well, so many copies of one key cost little.
    """
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be first or last, not {keep!r}")
    if keep == "last":
        order = [c.desc() for c in order]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


# --- gaps -----------------------------------------------------------------------------

def _steps(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """The distinct steps of each entity: copies collapse before any ordering."""
    return df.select(spec.entity, spec.idx).distinct()


def gaps(df: DataFrame, spec: PanelSpec = PANEL, size: int = DEFAULT_SLAB) -> DataFrame:
    """One row per gap: ``after`` and ``before`` are the indices around it."""
    stepped = previous_index(_steps(df, spec), [spec.entity], spec.idx, "after", size)
    return (stepped.filter(F.col(spec.idx) - F.col("after") > 1)
            .select(spec.entity, "after", F.col(spec.idx).alias("before"),
                    (F.col(spec.idx) - F.col("after") - 1).alias("missing")))


def missing_steps(df: DataFrame, spec: PanelSpec = PANEL, size: int = DEFAULT_SLAB) -> DataFrame:
    """Long form: one row per missing (entity, index)."""
    pieces = F.explode(F.sequence(slab_of(F.col("after") + 1, size),
                                  slab_of(F.col("before") - 1, size))).alias("_piece")
    cut = gaps(df, spec, size).select(spec.entity, "after", "before", pieces)
    low = F.greatest(F.col("after") + 1, F.col("_piece") * size)
    high = F.least(F.col("before") - 1, F.col("_piece") * size + (size - 1))
    return cut.select(spec.entity, F.explode(F.sequence(low, high)).alias(spec.idx))


def missing_report(df: DataFrame, spec: PanelSpec = PANEL, size: int = DEFAULT_SLAB,
                   with_list: bool = True) -> DataFrame:
    """Entities with missing steps: count and sorted list of indices.

    The list of an entity is bounded by the calendar (8,784 hours a year);
    :func:`missing_steps` is the form without lists.
    """
    steps = missing_steps(df, spec, size)
    out = [F.count("*").alias("missing_count")]
    if with_list:
        out.append(F.sort_array(F.collect_list(spec.idx)).alias("missing_time_idx"))
    return steps.groupBy(spec.entity).agg(*out)


def missing_counts(df: DataFrame, spec: PanelSpec = PANEL) -> DataFrame:
    """Missing steps of every entity, 0 included, by one aggregation."""
    return _steps(df, spec).groupBy(spec.entity).agg(
        (F.max(spec.idx) - F.min(spec.idx) + 1 - F.count("*")).alias("missing_count"))


def last_gap(df: DataFrame, spec: PanelSpec = PANEL, size: int = DEFAULT_SLAB) -> DataFrame:
    """Per entity with gaps: their number and the first row after the last one."""
    return gaps(df, spec, size).groupBy(spec.entity).agg(
        F.count("*").alias("n_gaps"), F.max("before").alias("block_start"))


def blocks(df: DataFrame, spec: PanelSpec = PANEL, size: int = DEFAULT_SLAB) -> DataFrame:
    """Uninterrupted blocks: first index, last index, number of steps.

    A block starts where the previous step is absent and ends where the next one is, which
    a halo of one step decides; starts and ends of an entity are then paired in order.
    """
    near = spread(_steps(df, spec), spec.idx, 1, 1, size)
    w = slab_window([spec.entity], spec.idx)
    edges = near.select(
        "*", F.coalesce(F.col(spec.idx) - F.lag(spec.idx).over(w) > 1, F.lit(True)).alias("_s"),
        F.coalesce(F.lead(spec.idx).over(w) - F.col(spec.idx) > 1, F.lit(True)).alias("_e"))
    edges = settle(edges, spec.idx, size).filter("_s or _e")
    homed = edges.withColumn(SLAB, slab_of(spec.idx, size))
    # Edges only: the next end at or after a start is in this slab or in a later one.
    down = slab_window([spec.entity], spec.idx, descending=True).rowsBetween(
        Window.unboundedPreceding, 0)
    local = homed.withColumn("_end", F.last(F.when(F.col("_e"), F.col(spec.idx)), True).over(down))
    later = Window.partitionBy(spec.entity).orderBy(F.col(SLAB).desc()).rowsBetween(
        Window.unboundedPreceding, -1)
    carried = (homed.groupBy(spec.entity, SLAB)
               .agg(F.min(F.when(F.col("_e"), F.col(spec.idx))).alias("_first"))
               .select(spec.entity, SLAB, F.last("_first", True).over(later).alias("_next")))
    return (rejoin(local.filter("_s"), carried, [spec.entity, SLAB])
            .select(spec.entity, F.col(spec.idx).alias("first_idx"),
                    F.coalesce("_end", "_next").alias("last_idx"))
            .withColumn("steps", F.col("last_idx") - F.col("first_idx") + 1))


def _tail_bounds(df: DataFrame, spec: PanelSpec, size: int) -> DataFrame:
    near = spread(_steps(df, spec), spec.idx, 1, 0, size)
    w = slab_window([spec.entity], spec.idx)
    starts = near.withColumn("_start", F.coalesce(
        F.col(spec.idx) - F.lag(spec.idx).over(w) > 1, F.lit(True)))
    return (settle(starts, spec.idx, size).groupBy(spec.entity)
            .agg(F.max(F.when(F.col("_start"), F.col(spec.idx))).alias("block_start"),
                 F.max(spec.idx).alias("_last"),
                 (F.max(spec.idx) - F.min(spec.idx) + 1 - F.count("*")).alias("missing_count")))


def tail_blocks(df: DataFrame, spec: PanelSpec = PANEL, max_missing: int = 3,
                min_days: int = 90, size: int = DEFAULT_SLAB) -> DataFrame:
    """Per entity: missing steps, start of the last block and the decision.

    ``keep`` up to ``max_missing`` missing steps; else ``trim`` to the last uninterrupted
    block, or ``drop`` when that block spans fewer than ``min_days`` whole days.
    """
    bounds = _tail_bounds(df, spec, size)
    hours = (F.col("_last") - F.col("block_start")) * spec.step_seconds / 3600
    decision = (F.when(F.col("missing_count") <= max_missing, "keep")
                .when(F.floor(hours / 24) < min_days, "drop").otherwise("trim"))
    return bounds.select(spec.entity, "missing_count", "block_start", decision.alias("decision"))


def trim_to_tail(df: DataFrame, spec: PanelSpec = PANEL, max_missing: int = 3,
                 min_days: int = 90, size: int = DEFAULT_SLAB) -> DataFrame:
    """Apply :func:`tail_blocks`."""
    plan = tail_blocks(df, spec, max_missing, min_days, size).filter("decision <> 'drop'")
    start = F.when(F.col("decision") == "trim", F.col("block_start"))
    kept = on_slabs(df, plan.select(spec.entity, start.alias("_from")), [spec.entity], slab_of(spec.idx, size))
    return kept.filter(F.col("_from").isNull() | (F.col(spec.idx) >= F.col("_from"))).drop("_from")


def trim_summary(df: DataFrame, spec: PanelSpec = PANEL, max_missing: int = 3,
                 min_days: int = 90, size: int = DEFAULT_SLAB) -> DataFrame:
    return (tail_blocks(df, spec, max_missing, min_days, size)
            .groupBy("decision").agg(F.count("*").alias("entities")))


def longest_gaps(df: DataFrame, spec: PanelSpec = PANEL, max_gap: int = 1,
                 size: int = DEFAULT_SLAB) -> DataFrame:
    """Missing steps and the longest run of them; OK, FILL or DROP."""
    stepped = previous_index(_steps(df, spec), [spec.entity], spec.idx, "_after", size)
    hole = F.coalesce(F.col(spec.idx) - F.col("_after") - 1, F.lit(0))
    runs = stepped.groupBy(spec.entity).agg(F.sum(hole).alias("missing_count"),
                                            F.max(hole).alias("longest_gap"))
    action = (F.when(F.col("missing_count") == 0, "OK")
              .when(F.col("longest_gap") > max_gap, "DROP").otherwise("FILL"))
    return runs.withColumn("action", action)


# --- completion -------------------------------------------------------------------------

def grid_of(bounds: DataFrame, first: str, last: str, spec: PanelSpec = PANEL,
            size: int = DEFAULT_SLAB) -> DataFrame:
    """Every index from ``first`` to ``last`` of each row, generated slab by slab."""
    pieces = F.explode(F.sequence(slab_of(first, size), slab_of(last, size))).alias(SLAB)
    low = F.greatest(F.col(first), F.col(SLAB) * size)
    high = F.least(F.col(last), F.col(SLAB) * size + (size - 1))
    rest = [c for c in bounds.columns if c not in (first, last)]
    return (bounds.select("*", pieces)
            .select(*rest, F.explode(F.sequence(low, high)).alias(spec.idx)))


def full_grid(df: DataFrame, spec: PanelSpec = PANEL, size: int = DEFAULT_SLAB) -> DataFrame:
    """Rows for every step between the first and last stamp of the entity, NULL where absent."""
    step = spec.step_seconds
    ends = df.groupBy(spec.entity).agg(F.min(spec.ts).alias("_ts0"), F.max(spec.ts).alias("_ts1"))
    origin = ends.agg(F.min("_ts0").alias("_o")).scalar()
    indexed = df.withColumn(spec.idx, hour_index(spec.ts, origin, step))
    first = hour_index("_ts0", origin, step)
    bounds = ends.select(spec.entity, "_ts0", first.alias("_a0"), first.alias("_a"),
                         hour_index("_ts1", origin, step).alias("_b"))
    grid = grid_of(bounds, "_a", "_b", spec, size).select(
        spec.entity, spec.idx,
        add_steps(F.col("_ts0"), F.col(spec.idx) - F.col("_a0"), step).alias(spec.ts))
    values = [c for c in df.columns if c not in (spec.entity, spec.ts, spec.idx)]
    joined = grid.join(indexed.select(spec.entity, spec.idx, *values), [spec.entity, spec.idx],
                       "left")
    order = df.columns if spec.idx in df.columns else [*df.columns, spec.idx]
    return joined.select(*order)


def spine(entities: DataFrame, start, end, spec: PanelSpec = PANEL) -> DataFrame:
    """Every entity at every step of a closed window (a generator, no join)."""
    start = F.lit(start).cast("timestamp_ntz") if isinstance(start, str) else start
    end = F.lit(end).cast("timestamp_ntz") if isinstance(end, str) else end
    steps = F.sequence(start, end, F.make_dt_interval(secs=F.lit(spec.step_seconds)))
    return entities.select(spec.entity).distinct().select(
        spec.entity, F.explode(steps).alias(spec.ts))


class WindowError(ValueError):
    """The forecast window does not fit the data."""


def extend(df: DataFrame, start, end, spec: PanelSpec = PANEL) -> DataFrame:
    """Add the rows of a forecast window that are absent, with NULL values.

    ``start`` must not precede the data; rows already present are kept once.
    """
    opening = F.lit(start).cast("timestamp_ntz")
    early, first = df.agg((opening < F.min(spec.ts).cast("timestamp_ntz")),
                          F.min(spec.ts).cast("string")).first()
    if early:
        raise WindowError(f"start {start} precedes the first stamp {first}")
    grid = spine(df, start, end, spec)
    new = grid.join(df.select(*spec.key), spec.key, "left_anti")
    return df.unionByName(new, allowMissingColumns=True)


# --- filling ---------------------------------------------------------------------------

def interpolate(df: DataFrame, columns: Sequence[str], spec: PanelSpec = PANEL,
                both_ends: bool = False, size: int = DEFAULT_SLAB) -> DataFrame:
    """Time-linear interpolation on the step index.

    Trailing gaps repeat the last value and leading ones stay NULL; with ``both_ends``
    leading gaps take the first value and an entity without any value gets 0.
    """
    near = neighbours(df, [spec.entity], spec.idx, columns, size)
    out = []
    for c in df.columns:
        if c not in columns:
            out.append(F.col(c))
            continue
        prev, nxt = F.col(f"{c}__prev"), F.col(f"{c}__next")
        a, b = F.col(f"{c}__prev_at"), F.col(f"{c}__next_at")
        line = prev + (nxt - prev) * (F.col(spec.idx) - a) / F.nullif(b - a, F.lit(0))
        choices = [F.col(c), line, prev] + ([nxt, F.lit(0.0)] if both_ends else [])
        out.append(F.coalesce(*choices).alias(c))
    return near.select(*out)


def fill_both_ways(df: DataFrame, columns: Sequence[str], spec: PanelSpec = PANEL,
                   default: dict | None = None, size: int = DEFAULT_SLAB) -> DataFrame:
    """Forward fill, then backward fill, then an optional default."""
    near = neighbours(df, [spec.entity], spec.idx, columns, size)
    default = default or {}
    return near.select(*[
        F.coalesce(F.col(c), F.col(f"{c}__prev"), F.col(f"{c}__next"),
                   *([F.lit(default[c])] if c in default else [])).alias(c)
        if c in columns else F.col(c) for c in df.columns])


def fill_forward_in_time(df: DataFrame, columns: Sequence[str], spec: PanelSpec = PANEL,
                         size: int = DEFAULT_SLAB) -> DataFrame:
    """Forward fill of a time-only table (no entity), in slabs."""
    near = neighbours(df, [], spec.idx, columns, size)
    return near.select(*[F.coalesce(c, f"{c}__prev").alias(c) if c in columns else F.col(c)
                         for c in df.columns])


def complete_time_table(df: DataFrame, spec: PanelSpec = PANEL, columns: Sequence[str] = (),
                        size: int = DEFAULT_SLAB) -> DataFrame:
    """All hours of a time-only table, absent ones filled forward."""
    keyed = df.withColumn("_one", F.lit(0))
    grid = full_grid(keyed, spec.with_(entity="_one"), size)
    return fill_forward_in_time(grid.drop("_one"), columns, spec, size)


def init_unknown(df: DataFrame, spec: PanelSpec = PANEL, output: str = "y_init") -> DataFrame:
    """Unknown targets start from the entity mean, or 0 without any."""
    out = group_values(df, [spec.entity], time_slab(spec.ts, spec.step_seconds), _mean=F.avg(spec.y))
    return out.select(*df.columns, F.coalesce(F.col(spec.y), F.col("_mean"), F.lit(0.0)).alias(output))


def placeholder_fill(df: DataFrame, spec: PanelSpec = PANEL, size: int = DEFAULT_SLAB) -> DataFrame:
    """Unknown targets repeat the nearest known one, or 0 without any."""
    return fill_both_ways(df, [spec.y], spec, {spec.y: 0.0}, size)


# --- splits ----------------------------------------------------------------------------

def label_splits(df: DataFrame, train_end, val_end, spec: PanelSpec = PANEL,
                 output: str = "data_subset") -> DataFrame:
    """train before ``train_end``, val before ``val_end``, everything later test."""
    kind = df.schema[spec.ts].dataType
    label = (F.when(F.col(spec.ts) < F.lit(train_end).cast(kind), "train")
             .when(F.col(spec.ts) < F.lit(val_end).cast(kind), "val").otherwise("test"))
    return df.withColumn(output, label)


def split_cutoffs(df: DataFrame, spec: PanelSpec = PANEL, split: str = "data_subset") -> DataFrame:
    return df.groupBy(split).agg(F.max(spec.idx).alias("cutoff"))


def reslice(df: DataFrame, cutoffs: DataFrame, spec: PanelSpec = PANEL,
            split: str = "data_subset") -> DataFrame:
    """Split label again from index cutoffs (after features were built on the union)."""
    def cutoff(name):
        return cutoffs.filter(F.col(split) == name).select("cutoff").scalar()
    i = F.col(spec.idx)
    label = F.when(i <= cutoff("train"), "train").when(i <= cutoff("val"), "val").otherwise("test")
    return df.withColumn(split, label)


def stitch_context(previous: DataFrame, target: DataFrame, length: int,
                   spec: PanelSpec = PANEL, order: str | None = None) -> DataFrame:
    """The last ``length`` rows of the previous split in front of the target, per entity."""
    wanted = target.select(spec.entity).distinct()
    context = last_rows(previous.join(wanted, spec.entity, "left_semi"), length, spec, order)
    return (context.withColumn("is_context", F.lit(True))
            .unionByName(target.withColumn("is_context", F.lit(False))))


def contiguous_lookback(df: DataFrame, length: int, spec: PanelSpec = PANEL,
                        size: int = DEFAULT_SLAB, output: str = "contiguous") -> DataFrame:
    """Whether the ``length`` rows before a row span exactly ``length`` steps.

    On a unique index this holds when none of the ``length`` steps before is absent, so a
    halo of ``length`` steps decides it.
    """
    near = spread(df, spec.idx, length, 0, size)
    frame = slab_window([spec.entity], spec.idx).rangeBetween(-length, -1)
    marked = near.withColumn(output, F.count(spec.idx).over(frame) == length)
    return settle(marked, spec.idx, size)
