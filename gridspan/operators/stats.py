"""Aggregations over panels: coverage, profiles, quantiles, growth, pivots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.coding import dense_codes
from ..plans.quantiles import exact_quantiles
from ..spec import PANEL, PanelSpec

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def coverage(df: DataFrame, spec: PanelSpec = PANEL) -> DataFrame:
    """First and last stamp, rows, and whether the entity spans the whole frame."""
    whole = df.agg(F.min(spec.ts).alias("a"), F.max(spec.ts).alias("b"))
    stats = df.groupBy(spec.entity).agg(F.min(spec.ts).alias("start"), F.max(spec.ts).alias("end"),
                                        F.count("*").alias("rows"))
    full = ((F.col("start") <= whole.select("a").scalar())
            & (F.col("end") >= whole.select("b").scalar()))
    return stats.withColumn("full_span", full)


def coverage_share(df: DataFrame, spec: PanelSpec = PANEL) -> DataFrame:
    c = coverage(df, spec)
    return c.agg(F.count("*").alias("entities"), F.count_if("full_span").alias("full"),
                 (F.avg(F.col("full_span").cast("double")) * 100).alias("full_span_pct"))


def time_profile(df: DataFrame, spec: PanelSpec = PANEL) -> DataFrame:
    """Fleet mean per stamp."""
    return df.groupBy(spec.ts).agg(F.avg(spec.y).alias("avg_y"))


def _month(ts):
    return F.trunc(ts, "month")


def prior_month_template(df: DataFrame, target_month: str, spec: PanelSpec = PANEL) -> DataFrame:
    """Mean by day of month and hour in the month before ``target_month`` (yyyy-MM-01)."""
    before = F.add_months(F.lit(target_month).cast("date"), -1)
    return (df.filter(_month(spec.ts) == before)
            .groupBy(spec.entity, F.dayofmonth(spec.ts).alias("day"), F.hour(spec.ts).alias("hour"))
            .agg(F.avg(spec.y).alias("template")))


def growth_factor(df: DataFrame, target_month: str, spec: PanelSpec = PANEL) -> DataFrame:
    """Mean of the same month last year over the mean of the month before it.

    1.0 when the base is missing or not positive; NULL when only the numerator is missing.
    """
    target = F.lit(target_month).cast("date")
    same, base = F.add_months(target, -12), F.add_months(target, -13)
    month = _month(spec.ts)
    means = (df.filter(month.isin(same, base)).groupBy(spec.entity)
             .agg(F.avg(F.when(month == same, F.col(spec.y))).alias("same"),
                  F.avg(F.when(month == base, F.col(spec.y))).alias("base")))
    return means.select(spec.entity, F.when(F.col("base") > 0, F.col("same") / F.col("base"))
                        .otherwise(F.lit(1.0)).alias("growth"))


def quartiles_by(df: DataFrame, group, name: str, spec: PanelSpec = PANEL) -> DataFrame:
    """Exact median and quartiles by an expression such as the hour of day."""
    return exact_quantiles(df.select(group.alias(name), spec.y), [name], spec.y, QUARTILES)


def histogram(df: DataFrame, column: str, bins: int = 100) -> DataFrame:
    """Equal-width bins between minimum and maximum, empty ones included."""
    limits = df.agg(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi"))
    lo, hi = limits.select("lo").scalar(), limits.select("hi").scalar()
    x = F.col(column)
    place = F.when(hi == lo, F.lit(bins // 2)).otherwise(
        F.least(F.floor((x - lo) / (hi - lo) * bins), F.lit(bins - 1)))
    counts = (df.filter(x.isNotNull()).groupBy(place.cast("int").alias("bin"))
              .agg(F.count("*").alias("n")))
    edges = limits.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "lo",
                          ((F.col("hi") - F.col("lo")) / bins).alias("w"))
    left = F.col("lo") + F.col("bin") * F.col("w")
    return edges.join(counts, "bin", "left").select(
        "bin", left.alias("left"), (left + F.col("w")).alias("right"),
        F.coalesce("n", F.lit(0)).alias("n"), ((left + F.col("w") / 2) < 0).alias("negative"))


def load_shapes(df: DataFrame, spec: PanelSpec = PANEL) -> DataFrame:
    """24 hourly and 7 weekday means, each divided by its own mean; absent ones are 0."""
    slots = df.groupBy(spec.entity, F.hour(spec.ts).alias("_h"), F.weekday(spec.ts).alias("_d")).agg(
        F.sum(spec.y).alias("_s"), F.count(spec.y).alias("_c"))

    def mean(slot, value):
        mine = F.col(slot) == value
        total = F.sum(F.when(mine, F.col("_s")))
        return F.coalesce(F.try_divide(total, F.sum(F.when(mine, F.col("_c")))), F.lit(0.0))

    means = slots.groupBy(spec.entity).agg(
        F.array(*[mean("_h", h) for h in range(24)]).alias("h"),
        F.array(*[mean("_d", w) for w in range(7)]).alias("d"))

    def level(values):
        m = F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v) / F.size(values)
        return F.when(m > 0, m).otherwise(F.lit(1.0))

    scaled = means.select(spec.entity, "h", "d", level("h").alias("_hl"), level("d").alias("_dl"))
    return scaled.select(spec.entity, *[(F.col("h")[i] / F.col("_hl")).alias(f"h{i}") for i in range(24)],
                         *[(F.col("d")[i] / F.col("_dl")).alias(f"d{i}") for i in range(7)])


def most_common(df: DataFrame, keys: Sequence[str], column: str, output: str = "mode") -> DataFrame:
    """Most frequent value per key, the smallest one on a tie."""
    counts = df.groupBy(*keys, column).count()
    top = counts.groupBy(*keys).agg(F.max("count").alias("_top"))
    joined = counts.join(top, list(keys)) if keys else counts.filter(
        F.col("count") == top.scalar())
    if keys:
        joined = joined.filter(F.col("count") == F.col("_top"))
    return joined.groupBy(*keys).agg(F.min(column).alias(output))


def group_sizes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact distinct counts, one row per column."""
    parts = [df.select(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")).distinct()
             for c in columns]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return union.groupBy("column").agg(F.count("v").alias("distinct_values"))


def first_values(df: DataFrame, columns: Sequence[str], spec: PanelSpec = PANEL) -> DataFrame:
    """Values on the first row of each entity (static attributes)."""
    return df.groupBy(spec.entity).agg(*[F.min_by(c, spec.ts).alias(c) for c in columns])


def request_plan(df: DataFrame, lat: str = "latitude", lon: str = "longitude",
                 spec: PanelSpec = PANEL) -> DataFrame:
    """Dates each location needs from a weather archive."""
    known = df.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    return known.groupBy(lat, lon).agg(F.to_date(F.min(spec.ts)).alias("start_date"),
                                       F.to_date(F.max(spec.ts)).alias("end_date"))


def wide(df: DataFrame, entities: Sequence, columns: Sequence[str],
         spec: PanelSpec = PANEL, by: str | None = None) -> DataFrame:
    """One row per step, one column per listed entity and feature; absent cells are 0.

    Fill along time on the long form first.  Only the listed entities become columns, at
    most 2,000 cells a row; :func:`wide_arrays` has no such limit.
    """
    if len(entities) * len(columns) > 2000:
        raise ValueError(f"{len(entities) * len(columns)} cells a row; use wide_arrays")
    aggs = [F.coalesce(F.max(F.when(F.col(spec.entity) == F.lit(e), F.col(c))), F.lit(0.0))
            .alias(f"{e}_{c}") for e in entities for c in columns]
    return (df.filter(F.col(spec.entity).isin(*entities)).groupBy(by or spec.idx).agg(*aggs))


def wide_arrays(df: DataFrame, columns: Sequence[str], spec: PanelSpec = PANEL,
                by: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The wide layout for any number of entities: rows per step, and a dictionary (entity, code).

    A row has ``codes``, ascending, and one array per feature with the values of these codes.  Entities
    absent at a step have no place in its arrays; a NULL value is 0, the largest of repeated cells
    stays, NULL entities have no code.  The plan has the same size for any number of entities and nothing
    is collected; a row grows with the entities present at its step.
    """
    step = by or spec.idx
    names = dense_codes(df, spec.entity)
    values = [F.col(c).alias(f"_v{i}") for i, c in enumerate(columns)]
    cells = (df.select(spec.entity, F.col(step).alias("_step"), *values)
             .join(names.withColumnRenamed("code", "_code"), spec.entity)
             .groupBy("_step", "_code").agg(*[F.coalesce(F.max(f"_v{i}"), F.lit(0.0)).alias(f"_v{i}")
                                              for i in range(len(columns))]))
    rows = cells.groupBy("_step").agg(F.sort_array(F.collect_list(
        F.struct("_code", *[f"_v{i}" for i in range(len(columns))]))).alias("_cells"))
    return rows.select(F.col("_step").alias(step), F.col("_cells._code").alias("codes"),
                       *[F.col(f"_cells._v{i}").alias(c) for i, c in enumerate(columns)]), names


def entity_summary(df: DataFrame, spec: PanelSpec = PANEL) -> DataFrame:
    """Rows with a target, its mean and sample standard deviation."""
    return df.groupBy(spec.entity).agg(F.count(spec.y).alias("rows"), F.avg(spec.y).alias("mean_y"),
                                       F.stddev_samp(spec.y).alias("std_y"))


def length_stats(df: DataFrame, minimum: int = 0, spec: PanelSpec = PANEL) -> DataFrame:
    """Shortest, longest and mean series; how many reach a minimum length."""
    lengths = df.groupBy(spec.entity).agg(F.count("*").alias("n"))
    return lengths.agg(F.count("*").alias("entities"), F.min("n").alias("min_len"),
                       F.max("n").alias("max_len"), F.avg("n").alias("mean_len"),
                       F.count_if(F.col("n") >= minimum).alias("long_enough"))


def profile(df: DataFrame, columns: Sequence[str], exact: bool = False) -> DataFrame:
    """Rows, nulls, range and distinct values of each column, in one pass."""
    distinct = F.count_distinct if exact else F.approx_count_distinct
    packed = df.agg(F.count("*").alias("_n"), *[F.struct(
        F.lit(c).alias("column"), F.count(c).alias("known"), F.min(c).cast("string").alias("lo"),
        F.max(c).cast("string").alias("hi"), distinct(c).alias("distinct_values")).alias(f"_{i}")
        for i, c in enumerate(columns)])
    width = len(df.columns)
    return packed.select("_n", F.inline(F.array(*[F.col(f"_{i}") for i in range(len(columns))]))
                         ).select("column", F.col("_n").alias("rows"),
                                  (F.col("_n") * width).alias("elements"),
                                  (F.col("_n") - F.col("known")).alias("nulls"), "lo", "hi",
                                  "distinct_values")
