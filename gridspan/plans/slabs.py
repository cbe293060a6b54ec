"""Ordered (window) work on panels without one task per entity.

``Window.partitionBy(entity)`` puts the whole history of an entity into one task; a hot
entity then decides the run time.  Here the time axis of every entity is cut into *slabs*
of a fixed number of steps and windows run per (entity, slab):

* bounded frames (lags, rolling windows): :func:`spread` copies only the few rows a
  neighbouring slab needs (the halo), :func:`settle` drops the copies afterwards;
* unbounded frames (fills, running sums): the window runs inside the slab, one summary row
  per slab is scanned per entity, and the carried state is joined back.

Both forms give exactly the result of the undivided window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLAB = "_slab"
DEFAULT_SLAB = 2016  # 12 weeks of hours


def slab_of(idx: str | Column, size: int) -> Column:
    idx = F.col(idx) if isinstance(idx, str) else idx
    return F.floor(idx / F.lit(size)).cast("long")


def spread(df: DataFrame, idx: str, back: int = 0, ahead: int = 0,
           size: int = DEFAULT_SLAB) -> DataFrame:
    """Assign rows to slabs, repeating a row in each slab whose frames reach it.

    ``back``/``ahead`` are the frame lengths in index steps.  Rows outside the home slab are
    at most ``(back + ahead) / size`` of the input.
    """
    if back == 0 and ahead == 0:
        return df.withColumn(SLAB, slab_of(idx, size))
    first = slab_of(F.col(idx) - ahead, size)
    last = slab_of(F.col(idx) + back, size)
    return df.withColumn(SLAB, F.explode(F.sequence(first, last)))


def settle(df: DataFrame, idx: str, size: int = DEFAULT_SLAB) -> DataFrame:
    """Keep each row once, in its home slab, and forget the slab."""
    return df.filter(F.col(SLAB) == slab_of(idx, size)).drop(SLAB)


def slab_window(keys: Sequence[str], idx: str, *, descending: bool = False):
    order = F.col(idx).desc() if descending else F.col(idx).asc()
    return Window.partitionBy(*keys, SLAB).orderBy(order)


def _across(keys: Sequence[str], *, descending: bool = False):
    """Earlier slabs (or later ones) of the same key; input has one row per slab."""
    order = F.col(SLAB).desc() if descending else F.col(SLAB).asc()
    part = [F.col(k) for k in keys] or [F.lit(0)]
    return Window.partitionBy(*part).orderBy(order).rowsBetween(
        Window.unboundedPreceding, -1)


def rejoin(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join on columns of the same name, where null equals null; ``on`` comes from the left."""
    names = {c: f"_on{i}" for i, c in enumerate(on)}
    other = right.select(*[F.col(c).alias(names.get(c, c)) for c in right.columns])
    same = [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()]
    return left.join(other, same, how).drop(*names.values())


def time_slab(ts: str, step_seconds: int, size: int = DEFAULT_SLAB) -> Column:
    """Slab of a row by its stamp, for frames without an index."""
    return F.floor(F.col(ts).cast("timestamp").cast("long") / (size * step_seconds)).cast("long")


def neighbours(df: DataFrame, keys: Sequence[str], idx: str, columns: Sequence[str],
               size: int = DEFAULT_SLAB) -> DataFrame:
    """Nearest known value at or before and at or after every row.

    Adds ``<c>__prev``, ``<c>__prev_at``, ``<c>__next`` and ``<c>__next_at`` per column.
    """
    keys = list(keys)
    homed = spread(df, idx, size=size)
    up = slab_window(keys, idx).rowsBetween(Window.unboundedPreceding, 0)
    down = slab_window(keys, idx, descending=True).rowsBetween(Window.unboundedPreceding, 0)

    local, parts, carried = homed, [], []
    for c in columns:
        at = F.when(F.col(c).isNotNull(), F.col(idx))
        local = (local
                 .withColumn(f"{c}__lp", F.last(c, ignorenulls=True).over(up))
                 .withColumn(f"{c}__lp_at", F.last(at, ignorenulls=True).over(up)))
        parts += [F.max_by(c, at).alias(f"{c}__last"), F.max(at).alias(f"{c}__last_at"),
                  F.min_by(c, at).alias(f"{c}__first"), F.min(at).alias(f"{c}__first_at")]
        before, after = _across(keys), _across(keys, descending=True)
        for suffix in ("", "_at"):
            carried.append(F.last(f"{c}__last{suffix}", ignorenulls=True).over(before)
                           .alias(f"{c}__cp{suffix}"))
            carried.append(F.last(f"{c}__first{suffix}", ignorenulls=True).over(after)
                           .alias(f"{c}__cn{suffix}"))
    for c in columns:
        at = F.when(F.col(c).isNotNull(), F.col(idx))
        local = (local
                 .withColumn(f"{c}__ln", F.last(c, ignorenulls=True).over(down))
                 .withColumn(f"{c}__ln_at", F.last(at, ignorenulls=True).over(down)))

    summary = homed.groupBy(*keys, SLAB).agg(*parts).select(*keys, SLAB, *carried)
    joined = rejoin(local, summary, [*keys, SLAB])
    found = []
    for c in columns:
        for suffix in ("", "_at"):
            found.append(F.coalesce(f"{c}__lp{suffix}", f"{c}__cp{suffix}")
                         .alias(f"{c}__prev{suffix}"))
            found.append(F.coalesce(f"{c}__ln{suffix}", f"{c}__cn{suffix}")
                         .alias(f"{c}__next{suffix}"))
    return joined.select(*df.columns, *found)


def running_sums(df: DataFrame, keys: Sequence[str], idx: str, sums: dict[str, Column],
                 size: int = DEFAULT_SLAB, inclusive: bool = True) -> DataFrame:
    """Running sums over the order of ``idx`` (unique per key), one column per entry."""
    keys = list(keys)
    homed = spread(df, idx, size=size)
    w = slab_window(keys, idx).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    summary = (homed.groupBy(*keys, SLAB)
               .agg(*[F.sum(e).alias(f"_{n}_part") for n, e in sums.items()])
               .select(*keys, SLAB, *[F.sum(f"_{n}_part").over(_across(keys)).alias(f"_{n}_before")
                                      for n in sums]))
    local = homed
    for n, e in sums.items():
        local = local.withColumn(f"_{n}_in", F.sum(e).over(w))
    joined = rejoin(local, summary, [*keys, SLAB])
    totals = []
    for n in sums:
        a, b = F.col(f"_{n}_in"), F.col(f"_{n}_before")
        totals.append(F.when(a.isNull() & b.isNull(), None)
                      .otherwise(F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))).alias(n))
    return joined.select(*df.columns, *totals)


def previous_index(df: DataFrame, keys: Sequence[str], idx: str, name: str = "prev_idx",
                   size: int = DEFAULT_SLAB) -> DataFrame:
    """Index of the nearest earlier row of the key, however far away; NULL on the first."""
    keys = list(keys)
    homed = spread(df, idx, size=size)
    local = homed.withColumn("_before_in", F.lag(idx).over(slab_window(keys, idx)))
    summary = (homed.groupBy(*keys, SLAB).agg(F.max(idx).alias("_top"))
               .select(*keys, SLAB, F.max("_top").over(_across(keys)).alias("_before_slab")))
    return rejoin(local, summary, [*keys, SLAB]).select(
        *df.columns, F.coalesce("_before_in", "_before_slab").alias(name))


def slab_arrays(df: DataFrame, keys: Sequence[str], idx: str, columns: Sequence[str], back: int = 0,
                ahead: int = 0, size: int = DEFAULT_SLAB, name: str = "_rows") -> DataFrame:
    """One row per (key, slab): ``name``, its rows in order of ``idx`` as structs of ``idx`` and ``columns``.

    The array also holds ``back`` steps before the slab and ``ahead`` steps after it, so every frame of a
    row of the slab lies inside.  Rows shuffled are at most ``1 + (back + ahead) / size`` times the input, and an array has
    at most ``size + back + ahead`` rows of a panel with one row a step.
    """
    near = spread(df.select(*keys, idx, *columns), idx, back, ahead, size)
    rows = F.sort_array(F.collect_list(F.struct(idx, *columns)))
    return near.groupBy(*keys, SLAB).agg(rows.alias(name))


def on_slabs(df: DataFrame, facts: DataFrame, keys: Sequence[str], slab: Column, how: str = "inner") -> DataFrame:
    """``df`` with the columns of ``facts`` (one row per key; null keys meet too), joined slab by slab.

    The facts of a key are first given to each of its slabs, which is a table with one row per slab; the
    rows then meet them on key and slab.  So no task gets all rows of a key, whatever its size.
    ``how`` is inner, left or left_semi.
    """
    keys = list(keys)
    homed = df.withColumn(SLAB, slab)
    slabs = homed.groupBy(*keys, SLAB).agg(F.lit(1).alias("_one")).drop("_one")
    placed = rejoin(slabs, facts, keys, "inner")
    return rejoin(homed, placed, [*keys, SLAB], how).drop(SLAB)
