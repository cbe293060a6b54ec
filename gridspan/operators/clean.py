"""Row and column cleaning of readings and panels."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.slabs import DEFAULT_SLAB, on_slabs, rejoin, time_slab
from ..spec import (COORDINATES, DROP_BEFORE, PANEL, PRICE_OVERRIDES, VALUE_CAPS, PanelSpec,
                    require_columns)

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATS = (T.FloatType, T.DoubleType)


def project(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Keep the named columns in order under new names (old -> new)."""
    require_columns(df, columns)
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in columns.items()])


def present(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    """The wanted columns the frame has, in the wanted order; warns about the others."""
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        warnings.warn(f"columns not in the frame: {missing}", stacklevel=2)
    return [c for c in wanted if c in df.columns]


def drop_by_prefix(df: DataFrame, *prefixes: str) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(prefixes)])


def safe_names(df: DataFrame) -> DataFrame:
    """Column names without dots."""
    return df.toDF(*[c.replace(".", "_") for c in df.columns])


def drop_labels(df: DataFrame, column: str, labels: Sequence[str]) -> DataFrame:
    """Drop summary rows by label; rows without a label stay."""
    return df.filter(F.col(column).isNull() | ~F.col(column).isin(*labels))


def rules_frame(spark, drop_before: Mapping[str, str], caps: Mapping[str, float] | None = None,
                overrides: Mapping[str, float] | None = None,
                entity: str = "entity") -> DataFrame:
    """One row per entity with any rule."""
    caps, overrides = caps or {}, overrides or {}
    names = sorted({*drop_before, *caps, *overrides})
    rows = [(n, drop_before.get(n), caps.get(n), overrides.get(n)) for n in names]
    return (spark.createDataFrame(rows, f"{entity} string, since string, cap double, fixed double")
            .withColumn("since", F.col("since").cast("timestamp_ntz")))


def published_rules(spark, entity: str = "entity") -> DataFrame:
    """The rule table of the published data set."""
    return rules_frame(spark, DROP_BEFORE, VALUE_CAPS, PRICE_OVERRIDES, entity)


def published_coordinates(spark, entity: str = "entity") -> DataFrame:
    """Coordinates of the entities the published dictionary leaves out."""
    rows = [(k, lat, lon) for k, (lat, lon) in COORDINATES.items()]
    return spark.createDataFrame(rows, f"{entity} string, latitude double, longitude double")


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every float column: aggregates and comparisons skip NULL only."""
    return df.select(*[
        F.nanvl(F.col(f"`{f.name}`"), F.lit(None).cast(f.dataType)).alias(f.name)
        if isinstance(f.dataType, _FLOATS) else F.col(f"`{f.name}`") for f in df.schema.fields])


def apply_rules(df: DataFrame, rules: DataFrame, spec: PanelSpec = PANEL,
                override_column: str | None = None) -> DataFrame:
    """Per-entity rules: drop rows before ``since``, cap ``y``, replace a constant column."""
    joined = df.join(rules, spec.entity, "left")
    kept = joined.filter(F.col("since").isNull()
                         | (F.col(spec.ts).cast("timestamp_ntz") >= F.col("since")))
    out = []
    for c in df.columns:
        if c == spec.y:
            out.append(F.when(F.col(c).isNotNull(), F.least(c, "cap")).alias(c))
        elif c == override_column:
            out.append(F.coalesce("fixed", c).alias(c))
        else:
            out.append(F.col(c))
    return kept.select(*out)


def patch_missing(df: DataFrame, patch: DataFrame, key: str, columns: Sequence[str],
                  sentinel: float = 0) -> DataFrame:
    """Replace the sentinel or NULL by the value of a patch table."""
    renamed = patch.select(key, *[F.col(c).alias(f"_patch_{c}") for c in columns])
    joined = df.join(renamed, key, "left")
    return joined.select(*[
        F.coalesce(F.nullif(F.col(c), F.lit(sentinel)), F.col(f"_patch_{c}")).alias(c)
        if c in columns else F.col(c) for c in df.columns])


def group_values(df: DataFrame, keys: Sequence[str], slab: Column | None = None, **aggregates: Column) -> DataFrame:
    """Group aggregates put back on the rows.

    Aggregates first (map-side combined) and joins the small result, so that a hot group is
    never brought together in one task as a partition-wide window would.  With ``slab``, a part of the
    group that the row belongs to, the rows of a group meet its result part by part.
    """
    stats = df.groupBy(*keys).agg(*[e.alias(n) for n, e in aggregates.items()])
    return rejoin(df, stats, keys) if slab is None else on_slabs(df, stats, keys, slab, "left")


def fill_by_group_max(df: DataFrame, column: str, spec: PanelSpec = PANEL,
                      flag: str | None = None, size: int = DEFAULT_SLAB) -> DataFrame:
    """Missing values become the largest ``y`` of the entity; ``flag`` records which."""
    joined = group_values(df, [spec.entity], time_slab(spec.ts, spec.step_seconds, size), _top=F.max(spec.y))
    out = [F.coalesce(column, "_top").alias(column) if c == column else F.col(c)
           for c in df.columns]
    if flag:
        out.append(F.when(F.col(column).isNotNull(), "Yes").otherwise("No").alias(flag))
    return joined.select(*out)


def covered_entities(df: DataFrame, spec: PanelSpec = PANEL, tail_days: int = 7,
                     min_rows: int = 90 * 24) -> DataFrame:
    """Entities that reach the last week of the frame and have enough observations."""
    stats = df.groupBy(spec.entity).agg(F.max(spec.ts).alias("_last"), F.count(spec.ts).alias("_n"))
    end = stats.agg(F.max("_last").alias("_end"))  # from the same aggregate, not another scan
    return (stats.filter((F.col("_last") >= end.scalar() - F.make_dt_interval(days=F.lit(tail_days)))
                         & (F.col("_n") >= min_rows))
            .select(spec.entity))


def keep_covered(df: DataFrame, spec: PanelSpec = PANEL, tail_days: int = 7,
                 min_rows: int = 90 * 24) -> DataFrame:
    return df.join(covered_entities(df, spec, tail_days, min_rows), spec.entity, "left_semi")


def keep_in_all_splits(df: DataFrame, splits: Sequence[str], spec: PanelSpec = PANEL,
                       split: str = "data_subset") -> DataFrame:
    """Rows of the entities that occur in every split."""
    seen = [F.max(F.when(F.col(split) == s, 1).otherwise(0)) for s in splits]
    full = (df.groupBy(spec.entity).agg(sum(seen[1:], seen[0]).alias("_n"))
            .filter(F.col("_n") == len(splits)).select(spec.entity))
    return df.join(full, spec.entity, "left_semi")


def over_capacity(df: DataFrame, capacity: str, spec: PanelSpec = PANEL, ratio: float = 1.25,
                  excess: float = 20) -> DataFrame:
    """Rows above the capacity by both a ratio and an absolute amount."""
    y, cap = F.col(spec.y), F.col(capacity)
    return df.filter((y > F.lit(ratio) * cap) & (y - cap > excess))


def between(df: DataFrame, start=None, end=None, entities: Sequence[str] | None = None,
            spec: PanelSpec = PANEL) -> DataFrame:
    """Closed time range and entity list, both pushed to the scan."""
    if entities is not None:
        df = df.filter(F.col(spec.entity).isin(*entities))
    if start is not None:
        df = df.filter(F.col(spec.ts) >= F.lit(start).cast(df.schema[spec.ts].dataType))
    if end is not None:
        df = df.filter(F.col(spec.ts) <= F.lit(end).cast(df.schema[spec.ts].dataType))
    return df


def to_forecast(df: DataFrame, spec: PanelSpec = PANEL) -> DataFrame:
    """Rows whose target is unknown."""
    return df.filter(F.col(spec.y).isNull())


def clip(value: str | Column, upper: str | Column | None = None) -> Column:
    """Non-negative value, optionally bounded above; NULL stays NULL."""
    value = F.col(value) if isinstance(value, str) else value
    upper = F.col(upper) if isinstance(upper, str) else upper
    bounded = value if upper is None else F.least(value, upper)
    return F.when(value.isNotNull(), F.greatest(bounded, F.lit(0.0)))


def require_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def count_excluded(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How many rows :func:`require_values` keeps and drops."""
    whole = F.lit(True)
    for c in columns:
        whole = whole & F.col(c).isNotNull()
    return df.agg(F.count("*").alias("rows"), F.count_if(whole).alias("kept"),
                  F.count_if(~whole).alias("excluded"))


def last_rows(df: DataFrame, n: int, spec: PanelSpec = PANEL, order: str | None = None) -> DataFrame:
    """The last ``n`` rows of every entity.

    The rank filter is applied per input task before the shuffle (window group limit), so a
    hot entity sends at most ``n`` rows per task.
    """
    w = Window.partitionBy(spec.entity).orderBy(F.col(order or spec.ts).desc())
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def first_rows(df: DataFrame, n: int, spec: PanelSpec = PANEL, order: str | None = None) -> DataFrame:
    w = Window.partitionBy(spec.entity).orderBy(F.col(order or spec.ts).asc())
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def narrowing_profile(df: DataFrame) -> DataFrame:
    """Range, decimals (up to 3, 4 = more) and chosen storage of every numeric column."""
    numeric = [f for f in df.schema.fields if isinstance(f.dataType, _INTEGERS + _FLOATS)]
    aggs = []
    for f in numeric:
        c = F.col(f"`{f.name}`")
        x = c.cast("double")
        if isinstance(f.dataType, _FLOATS):
            digits = F.when(x == F.round(x, 0), 0).when(x == F.round(x, 1), 1) \
                .when(x == F.round(x, 2), 2).when(x == F.round(x, 3), 3).when(x.isNotNull(), 4)
        else:
            digits = F.when(x.isNotNull(), 0)
        aggs.append(F.struct(
            F.lit(f.name).alias("column"), F.min(x).alias("lo"), F.max(x).alias("hi"),
            F.coalesce(F.max(digits), F.lit(4)).alias("decimals"),
            F.lit(isinstance(f.dataType, _INTEGERS)).alias("is_int")).alias(f"_{len(aggs)}"))
    one = df.agg(*aggs)
    rows = one.select(F.inline(F.array(*[F.col(f"_{i}") for i in range(len(aggs))])))
    scale = F.pow(F.lit(10.0), F.col("decimals"))
    lo, hi = F.round(F.col("lo") * scale), F.round(F.col("hi") * scale)
    fits = lambda bits: (lo >= -(2 ** (bits - 1))) & (hi <= 2 ** (bits - 1) - 1)
    exact = F.col("is_int")
    stored = (F.when(F.col("lo").isNull(), F.when(exact, "bigint").otherwise("float"))
              .when(exact & fits(8), "tinyint").when(exact & fits(16), "smallint")
              .when(exact & fits(32), "int").when(exact, "bigint")
              .when((F.col("decimals") <= 3) & fits(8), "tinyint")
              .when((F.col("decimals") <= 3) & fits(16), "smallint")
              .otherwise("float"))
    scaled = ~exact & stored.isin("tinyint", "smallint")
    return rows.select("column", "lo", "hi", F.col("decimals").cast("int").alias("decimals"),
                       stored.alias("stored_as"),
                       F.when(scaled, scale).otherwise(F.lit(1.0)).cast("int").alias("scale"))


def narrow(df: DataFrame, profile: DataFrame | None = None) -> DataFrame:
    """Store numeric columns in the smallest type; the scale is kept in column metadata.

    Reads the profile (one row per column) to the driver.
    """
    plan = {r["column"]: r for r in (profile or narrowing_profile(df)).collect()}
    out = []
    for c in df.columns:
        if c not in plan:
            out.append(F.col(f"`{c}`"))
            continue
        stored, scale = plan[c]["stored_as"], plan[c]["scale"]
        x = F.col(f"`{c}`")
        x = F.round(x * scale).cast(stored) if scale != 1 else x.cast(stored)
        out.append(x.alias(c, metadata={"stored_as": stored, "scale": scale}))
    return df.select(*out)


def widen(df: DataFrame) -> DataFrame:
    """Undo :func:`narrow` from the column metadata."""
    out = []
    for f in df.schema.fields:
        scale = f.metadata.get("scale", 1) if f.metadata else 1
        x = F.col(f"`{f.name}`")
        out.append((x.cast("double") / scale).alias(f.name) if scale != 1 else x)
    return df.select(*out)


def sample_entities(df: DataFrame, n: int, seed: int = 42, spec: PanelSpec = PANEL) -> DataFrame:
    """``n`` entities chosen by a seeded hash; the same choice on every run and split."""
    chosen = (df.select(spec.entity).distinct()
              .orderBy(F.xxhash64(F.col(spec.entity), F.lit(seed)), spec.entity).limit(n))
    return df.join(chosen, spec.entity, "left_semi")


def require_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Schema check before scoring."""
    return require_columns(df, features)


def align(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the training columns in training order; absent ones are 0."""
    return df.select(*keep, *[F.col(f"`{c}`") if c in df.columns else F.lit(0).alias(c)
                              for c in columns])


def check_unique_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (empty for a valid panel)."""
    return df.groupBy(*keys).count().filter("count > 1")

