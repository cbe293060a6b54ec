"""Joins of a panel with dimensions, dated facts, prices, weather and alarms.

Equi-joins carry no broadcast hint: Spark broadcasts a side below its size threshold, and a
larger side is shuffled with adaptive skew splitting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import EARTH_KM, great_circle
from ..plans.slabs import running_sums
from ..spec import PANEL, PanelSpec


def with_dimension(df: DataFrame, dim: DataFrame, keys: Sequence[str],
                   suffix: str = "_dict") -> DataFrame:
    """Left equi-join; columns of the dimension that clash get a suffix."""
    keys = list(keys)
    renamed = dim.select(*[F.col(c) if c in keys or c not in df.columns
                           else F.col(c).alias(c + suffix) for c in dim.columns])
    return df.join(renamed, keys, "left")


def effective_value(df: DataFrame, installs: DataFrame, since: str, value: str,
                    spec: PanelSpec = PANEL, output: str = "max_solar") -> DataFrame:
    """One dated value per entity: active on days strictly after the install date, else 0."""
    side = installs.select(spec.entity, F.to_date(since).alias("_since"), F.col(value).alias("_v"))
    active = F.to_date(spec.ts) > F.col("_since")
    return df.join(side, spec.entity, "left").select(
        *[c for c in df.columns if c != output],
        F.when(active, F.col("_v")).otherwise(F.lit(0.0)).alias(output))


def _seconds(c: str) -> Column:
    return F.col(c).cast("timestamp").cast("long")


def effective_sum(df: DataFrame, installs: DataFrame, since: str, value: str,
                  spec: PanelSpec = PANEL, output: str = "max_ev",
                  slab_days: int = 84) -> DataFrame:
    """Sum of the values installed at or before each stamp (many installs per entity).

    Panel rows and installs are ordered on one time line per entity and a running sum is
    taken in slabs, so the work is linear in both sides and no (row, install) pairs arise.
    """
    starts = (installs.filter(F.col(since).isNotNull() & F.col(value).isNotNull())
              .groupBy(spec.entity, _seconds(since).alias("_at")).agg(F.sum(value).alias("_add")))
    # Even positions are installs, odd ones rows: an install at a stamp counts for it.
    rows = df.select("*", (_seconds(spec.ts) * 2 + 1).alias("_pos"),
                     F.lit(0.0).alias("_add"), F.lit(True).alias("_row"))
    adds = starts.select(spec.entity, (F.col("_at") * 2).alias("_pos"), "_add",
                         F.lit(False).alias("_row"))
    line = rows.unionByName(adds, allowMissingColumns=True)
    summed = running_sums(line, [spec.entity], "_pos", {output: F.col("_add")},
                          size=slab_days * 86400 * 2)
    return summed.filter("_row").select(*df.columns, F.coalesce(output, F.lit(0.0)).alias(output))


def translate_key(df: DataFrame, bridge: DataFrame, old: str, new: str) -> DataFrame:
    """Replace a key through a bridge table; rows without a match or with NULLs are dropped."""
    pairs = bridge.select(old, new).filter(F.col(new).isNotNull()).distinct()
    return df.dropna().join(pairs, old).select(
        new, *[c for c in df.columns if c not in (old, new)])


def with_prices(df: DataFrame, prices: DataFrame, spec: PanelSpec = PANEL) -> DataFrame:
    """Time-only price columns on every entity."""
    return df.join(prices, spec.ts, "left")


def location_key(lat: str, lon: str, digits: int = 4) -> list[Column]:
    """Integer coordinates, so that equality does not depend on float noise."""
    scale = 10 ** digits
    return [F.round(F.col(lat) * scale).cast("long").alias("_lat"),
            F.round(F.col(lon) * scale).cast("long").alias("_lon")]


def fill_weather(df: DataFrame, weather: DataFrame, columns: Sequence[str],
                 spec: PanelSpec = PANEL, lat: str = "latitude", lon: str = "longitude",
                 order: str | None = None) -> DataFrame:
    """Join hourly weather by rounded location and time; only missing values are filled.

    Of duplicate weather rows the last one by ``order`` is taken whole; without an order, and
    on a tie, the one with the largest values, compared column by column.
    """
    source = weather.select("*", *location_key(lat, lon))
    keys = [spec.ts, "_lat", "_lon"]
    ranked = [F.col(order).alias("_order")] if order else []
    new = F.struct(*ranked, *[F.col(c).alias(f"{c}__new") for c in columns])
    latest = source.groupBy(*keys).agg(F.max(new).alias("_new")).select(
        *keys, *[f"_new.{c}__new" for c in columns])
    joined = df.select("*", *location_key(lat, lon)).join(latest, keys, "left")
    kept = [c for c in df.columns if c not in columns]
    filled = [F.coalesce(c, f"{c}__new").alias(c) if c in df.columns
              else F.col(f"{c}__new").alias(c) for c in columns]
    return joined.select(*kept, *filled)


def lacking(df: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``done`` yet (the work left of a resumable enrichment)."""
    return df.join(done.select(*keys).distinct(), list(keys), "left_anti")


def attach_actuals(forecast: DataFrame, actuals: DataFrame, keys: Sequence[str],
                   columns: Sequence[str], how: str = "inner") -> DataFrame:
    """Actuals and prices on forecasts; the right side is reduced to one row per key (the
    largest by ``columns`` when copies differ)."""
    keys = list(keys)
    right = actuals.groupBy(*keys).agg(F.max(F.struct(*columns)).alias("_a")).select(*keys, "_a.*")
    return forecast.drop(*columns).join(right, keys, how)


def semi(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(keys, list(on), "left_semi")


# --- alarms -----------------------------------------------------------------------------

_HOUR = 3_600_000_000  # microseconds


def alarm_hours(alarms: DataFrame, region: str = "region_id", start: str = "start",
                end: str = "end", until: Column | None = None) -> DataFrame:
    """Alarm intervals to region-hours: number of alarms, and minutes under any alarm.

    Alarms that overlap are not counted twice in ``minutes``.  An alarm without an end lasts to
    ``until``, by default the latest stamp of the table.  Alarms are cut by day, then by hour; the
    parts of one region and hour are merged in order of their starts.
    """
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    known = alarms.filter(F.col(start).isNotNull())
    if until is None:
        until = known.agg(F.max(F.greatest(start, end)).alias("_until")).scalar()
    spans = known.select(region, micros(F.col(start)).alias("_a"),
                         micros(F.coalesce(F.col(end), until)).alias("_b")).filter("_b > _a")
    hour = lambda c: f"(({c}) - pmod({c}, {_HOUR})) div {_HOUR}"
    spans = spans.withColumn("_first", F.expr(hour("_a"))).withColumn("_last", F.expr(hour("_b - 1")))
    days = spans.withColumn("_day", F.explode(F.expr(
        "sequence((_first - pmod(_first, 24)) div 24, (_last - pmod(_last, 24)) div 24)")))
    parts = days.withColumn("_h", F.explode(F.expr(
        "sequence(greatest(_first, _day * 24), least(_last, _day * 24 + 23))")))
    begun = parts.groupBy(region, "_h", F.greatest("_a", F.col("_h") * _HOUR).alias("_from")).agg(
        F.max(F.least("_b", (F.col("_h") + 1) * _HOUR)).alias("_to"), F.count("*").alias("_n"))
    earlier = Window.partitionBy(region, "_h").orderBy("_from").rowsBetween(Window.unboundedPreceding, -1)
    covered = F.greatest("_from", F.max("_to").over(earlier))
    return (begun.withColumn("_s", F.greatest(F.col("_to") - covered, F.lit(0)))
            .groupBy(region, F.timestamp_micros(F.col("_h") * _HOUR).alias("ts"))
            .agg(F.sum("_n").alias("alarms"), (F.sum("_s") / 60e6).alias("minutes")))


def requirement_spans(df: DataFrame, region: str, ids: DataFrame,
                      spec: PanelSpec = PANEL) -> DataFrame:
    """First and last stamp needed per region, with the region's id."""
    spans = df.groupBy(region).agg(F.min(spec.ts).alias("start"), F.max(spec.ts).alias("end"))
    return spans.join(ids, region, "left")


# --- neighbours on the sphere -----------------------------------------------------------

_DISTANCE_DIGITS = 6


def _cells(level: int, lat: str, lon: str) -> tuple[Column, Column]:
    size = 360.0 / 2 ** level
    return (F.floor((F.col(lat) + 90) / size).cast("long"),
            F.floor((F.col(lon) + 180) / size).cast("long") % 2 ** level)


def _on_levels(rows: DataFrame, levels: Sequence[int]) -> DataFrame:
    """Each row once a level, with its cell there: level, row, col."""
    cells = [F.struct(F.lit(v).alias("level"), *[c.alias(n) for c, n in zip(_cells(v, "lat", "lon"), ("row", "col"))])
             for v in levels]
    return rows.select("*", F.inline(F.array(*cells)))


def _spread(places: DataFrame) -> DataFrame:
    """Places over all shuffle partitions, not joined by their bytes: each becomes many rows later.

    The order of the columns differs from that of groupings, whose shuffle would otherwise stand in for this one.
    """
    return places.repartition(int(places.sparkSession.conf.get("spark.sql.shuffle.partitions")), "lon", "lat")


def search_levels(offered: DataFrame, k: int, top: int) -> DataFrame:
    """lat, lon, reach, level: the k + 1 nearest members of a place are within ``reach`` km, and in the 3 x 3 cells of ``level``.

    Members are counted once a level.  A place's block is its coarsest cell with at most ``8 * (k + 1)`` members; the
    distance of the (k + 1)-th nearest of those is the reach.  Blocks with too few members, and crowds in one cell of the finest level,
    fall back to the farther sides of the finest cell with k + 1 members.  The level is the finest one whose cells reach that
    far on every side.  Level 1, which is the whole sphere, is for places without such a cell or too near a pole.
    """
    levels, block, most = range(top, 0, -1), ["level", "row", "col"], 8 * (k + 1)
    points = _spread(offered.groupBy("lat", "lon").agg(F.count("*").alias("c")))
    held = _on_levels(points, levels).groupBy(*block).agg(F.sum("c").alias("n"))
    own = _on_levels(points, levels).join(held, block).groupBy("lat", "lon", "c").agg(
        F.max(F.when(F.col("n") > k, F.col("level"))).alias("_v"),
        F.min(F.when(F.col("n") <= most, F.struct(*block, "n"))).alias("_b"))
    near = F.coalesce(F.col("_b.n") > k, F.lit(False))
    grouped = own.groupBy(F.when(near, F.col("_b")).alias("_b"), F.when(~near, F.col("lat")).alias("_la"),
                          F.when(~near, F.col("lon")).alias("_lo")).agg(
        F.collect_list(F.struct("lat", "lon", "c", "_v")).alias("_all"))
    finest = grouped.select(F.col("_b.n").alias("_n"), "_all", F.explode("_all").alias("_p")).select("_n", "_all", "_p.*")
    met = F.flatten(F.transform("_all", lambda x: F.array_repeat(F.round(great_circle(
        F.col("lat"), F.col("lon"), x["lat"], x["lon"]), _DISTANCE_DIGITS), x["c"].cast("int"))))
    size = F.lit(360.0) / F.pow(F.lit(2.0), F.col("_v"))
    up, right = F.pmod(F.col("lat") + 90, size), F.pmod(F.col("lon") + 180, size)
    # Along the parallel and then along the meridian, to the farther sides of the cell.
    far = F.radians(F.greatest(up, size - up) + F.greatest(right, size - right) * F.cos(F.radians("lat"))) * EARTH_KM
    # Distances are rounded, so the reach has a margin.
    reach = F.least(F.when(F.col("_n").isNotNull(), F.sort_array(met)[k]), far) * 1.000001 + 1e-5
    known = finest.select("lat", "lon", "_v", reach.alias("reach"))
    fits = [F.when(F.asin(F.lit(_sine(360.0 / 2 ** v)) * F.cos(F.radians("lat"))) * 0.999999 >= F.col("reach") / EARTH_KM,
                   F.lit(v)) for v in levels]
    return known.select("lat", "lon", "reach", F.coalesce(*fits, F.lit(1)).alias("level"))


def nearest(dim: DataFrame, key: str, lat: str, lon: str, k: int = 8, top: int = 24) -> DataFrame:
    """Exact k nearest other members by great-circle distance (ties by key).

    Every place is searched in cells of its own level (:func:`search_levels`), all levels in one join: small
    cells where members are dense, large ones only for the few places that are alone.  Only members within its reach
    are ordered.  Members at equal
    coordinates are searched once, each place offering its first k + 1 members.  A member without
    coordinates has no neighbours and is none.
    """
    members = dim.select(F.col(key).alias("id"), F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon"))
    first = Window.partitionBy("lat", "lon").orderBy("id")
    offered = (members.filter("lat is not null and lon is not null").withColumn("_r", F.row_number().over(first))
               .filter(F.col("_r") <= k + 1).drop("_r"))
    places = _spread(search_levels(offered, k, top))
    wide = F.pow(F.lit(2.0), F.col("level"))
    row = F.floor((F.col("lat") + 90) / (F.lit(360.0) / wide)).cast("long")
    col = F.floor((F.col("lon") + 180) / (F.lit(360.0) / wide)).cast("long") % wide.cast("long")
    around = F.array_distinct(F.array(*[
        F.struct((row + a).alias("row"), F.pmod(col + b, wide.cast("long")).alias("col")) for a in (-1, 0, 1) for b in (-1, 0, 1)]))
    asked = places.select("lat", "lon", "reach", "level", F.inline(around))
    target = _on_levels(offered.select("id", F.col("lat"), F.col("lon")), range(top, 0, -1)).select(
        "id", F.col("lat").alias("lat2"), F.col("lon").alias("lon2"), "level", "row", "col")
    near = asked.join(target, ["level", "row", "col"]).withColumn(
        "distance", F.round(great_circle("lat", "lon", "lat2", "lon2"), _DISTANCE_DIGITS)).filter(
        F.col("reach").isNull() | (F.col("distance") <= F.col("reach")))
    best = Window.partitionBy("lat", "lon").orderBy("distance", "id")
    candidates = near.withColumn("_r", F.row_number().over(best)).filter(F.col("_r") <= k + 1).select(
        "lat", "lon", "id", "distance")
    pairs = (members.select(F.col("id").alias("src"), "lat", "lon")
             .join(candidates, ["lat", "lon"]).filter(F.col("src") != F.col("id")))
    own = Window.partitionBy("src").orderBy("distance", "id")
    return (pairs.withColumn("rank", F.row_number().over(own)).filter(F.col("rank") <= k)
            .select("src", F.col("id").alias("dst"), "rank", "distance"))


def _sine(degrees: float) -> float:
    import math
    return math.sin(math.radians(min(degrees, 90.0)))


def neighbour_graph(pairs: DataFrame) -> DataFrame:
    """Symmetric edges with self-loops and weights that sum to 1 per ``dst``."""
    edges = pairs.select("src", "dst")
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    loops = both.select("src", F.col("src").alias("dst"))
    edges = both.unionByName(loops).distinct()
    degree = edges.groupBy("dst").agg((F.lit(1.0) / F.count("*")).alias("weight"))
    return edges.join(degree, "dst").select("src", "dst", "weight")


def neighbour_mean(panel: DataFrame, edges: DataFrame, columns: Sequence[str],
                   spec: PanelSpec = PANEL) -> DataFrame:
    """Weighted neighbour values (self included) of every entity and step."""
    joined = panel.select(F.col(spec.entity).alias("src"), spec.ts, *columns).join(edges, "src")
    return (joined.groupBy(F.col("dst").alias(spec.entity), spec.ts)
            .agg(*[F.sum(F.col("weight") * F.col(c)).alias(f"{c}_near") for c in columns]))


__all__ = [
    "alarm_hours", "attach_actuals", "effective_sum", "effective_value",
    "fill_weather", "lacking", "location_key", "nearest", "neighbour_graph", "neighbour_mean",
    "requirement_spans", "search_levels", "semi", "translate_key", "with_dimension", "with_prices",
]
