"""The whole build and the whole inference as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import build as B
from ..operators import clean as K
from ..operators import forecast as H
from ..plans.lineage import new_path
from ..sources import sinks as W
from . import fixtures as X
from .registry import query, with_

# Attributes of an event type, derived from its own events.
_S_DIM = """dim AS (SELECT event_type AS entity, CAST(44 + min(user_id) % 7 AS DOUBLE) AS latitude, CAST(22 + count(*)
  % 9 AS DOUBLE) AS longitude, 'T' || count(*) % 3 AS station_type FROM events GROUP BY 1),
  solar AS (SELECT event_type AS entity, date_trunc('day', min(ts)) + INTERVAL 9 DAY AS since, max(value) AS power
    FROM events WHERE event_type <> 'view' GROUP BY 1),
  chargers AS (SELECT event_type AS entity, date_trunc('hour', ts) AS since, value AS power FROM events),
  weather AS (SELECT date_trunc('hour', ts) AS ts, d.latitude, d.longitude, arg_max(value, event_id) AS
    temperature_2m FROM events e JOIN dim d ON d.entity = e.event_type GROUP BY 1, 2, 3)"""


def _sources(spark, d) -> B.Sources:
    e = X.readings(spark, d)
    dim = e.groupBy("entity").agg(
        (44 + F.min("user_id") % 7).cast("double").alias("latitude"),
        (22 + F.count("*") % 9).cast("double").alias("longitude"),
        F.concat(F.lit("T"), (F.count("*") % 3).cast("string")).alias("station_type"))
    solar = e.filter("entity <> 'view'").groupBy("entity").agg(
        (F.date_trunc("day", F.min("ts")) + F.expr("interval 9 days")).alias("since"),
        F.max("y").alias("power"))
    chargers = e.select(
        "entity", F.date_trunc("hour", "ts").alias("since"), F.col("y").alias("power"))
    weather = e.join(dim, "entity").groupBy(
        F.date_trunc("hour", "ts").alias("ts"), "latitude", "longitude").agg(
        F.max_by("y", "event_id").alias("temperature_2m"))
    capacity = dim.filter("entity <> 'click'").select("entity", F.lit(400.0).alias("max_power"))
    rules = K.rules_frame(spark, {"view": "2024-01-10"}, {"click": 150.0})
    return B.Sources(e.select("entity", "ts", "y"), dim, None, solar, chargers, capacity, rules, weather,
                     X.prices(spark, d), ("temperature_2m",))


_OPT = B.BuildOptions(min_rows=48, max_missing=10_000, min_days=0, max_gap=60, train_end="2024-01-20",
                      val_end="2024-01-25", size=168)

_S_SILVER = _S_DIM + ", " + X.S_PRICES + """, c0 AS (SELECT event_type AS entity, date_trunc('hour', ts) AS ts,
  max(value) AS y FROM events GROUP BY 1, 2),
  c1 AS (SELECT entity, ts, max(y) OVER (PARTITION BY entity) AS top, CASE WHEN entity = 'click' THEN least(y, 150.0)
    ELSE y END AS y FROM c0
    WHERE NOT (entity = 'view' AND ts < TIMESTAMP '2024-01-10')),
  c2 AS (SELECT * FROM c1 WHERE entity IN (SELECT entity FROM c1 GROUP BY 1 HAVING max(ts) >= (SELECT max(ts) FROM c1)
    - INTERVAL 7 DAY AND count(*) >= 48)),
  c3 AS (SELECT c.entity, c.ts, c.y, d.latitude, d.longitude, d.station_type, CASE WHEN CAST(c.ts AS DATE) >
    CAST(s.since AS DATE) THEN s.power ELSE 0.0 END AS max_solar, CASE WHEN c.entity <> 'click' THEN 400.0 ELSE
    c.top END AS max_power, coalesce((SELECT sum(power) FROM chargers g WHERE g.entity
    = c.entity AND g.since <= c.ts), 0.0) AS max_ev, w.temperature_2m FROM c2 c JOIN dim d ON d.entity = c.entity
    LEFT JOIN solar s ON s.entity = c.entity LEFT JOIN weather w ON w.ts = c.ts AND w.latitude = d.latitude AND
    w.longitude = d.longitude),
  cells AS (SELECT entity, unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM c3 GROUP BY 1),
  g0 AS (SELECT c.entity, c.ts, y, max_solar, max_power, max_ev, temperature_2m, epoch(c.ts) / 3600 AS t FROM cells c
    LEFT JOIN c3 ON c3.entity = c.entity AND c3.ts = c.ts)"""
_NUM = ("y", "max_solar", "max_power", "max_ev", "temperature_2m")
_S_FILLED = _S_SILVER + ", near AS (SELECT *, " + ", ".join(
    f"last_value({c} IGNORE NULLS) OVER p AS {c}_p, last_value(CASE WHEN {c} IS NOT NULL THEN t END IGNORE NULLS) "
    f"OVER p AS {c}_pt, first_value({c} IGNORE NULLS) OVER n AS {c}_n, first_value(CASE WHEN {c} IS NOT NULL THEN t "
    f"END IGNORE NULLS) OVER n AS {c}_nt" for c in _NUM) + """ FROM g0 WINDOW p AS (PARTITION BY entity ORDER BY ts
  ROWS UNBOUNDED PRECEDING), n AS (PARTITION BY entity ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
  silver AS (SELECT n.entity, n.ts, date_diff('hour', (SELECT min(ts) FROM g0), n.ts) AS time_idx, """ + ", ".join(
    f"coalesce(n.{c}, {c}_p + ({c}_n - {c}_p) * (t - {c}_pt) / nullif({c}_nt - {c}_pt, 0), {c}_p) AS {c}"
    for c in _NUM) + """, d.latitude, d.longitude, d.station_type, p.dam_price, p.buy_bm_price, CASE WHEN n.ts <
  TIMESTAMP '2024-01-20' THEN 'train' WHEN n.ts < TIMESTAMP '2024-01-25' THEN 'val' ELSE 'test' END AS data_subset
  FROM near n JOIN dim d ON d.entity = n.entity LEFT JOIN prices p ON p.ts = n.ts)"""


@query("silver_build", with_(_S_FILLED, body="SELECT * FROM silver"),
       "y max_solar max_power max_ev temperature_2m latitude longitude dam_price buy_bm_price")
def silver(spark, d):
    df = B.build_silver(_sources(spark, d), _OPT)
    return df.select("entity", "ts", "time_idx", *_NUM, "latitude", "longitude", "station_type", "dam_price", "buy_bm_price",
                     "data_subset")


@query("gold_build", with_(_S_FILLED, body="""SELECT data_subset, count(*) AS rows, sum(y) AS load, sum(max_ev) AS
  chargers, sum(temperature_2m) AS warmth, CAST(count(*) FILTER (extract(hour FROM ts) = 5) AS BIGINT) AS hour_5 FROM silver GROUP BY 1"""), "load chargers warmth", 2)
def gold(spark, d):
    root = new_path(spark, "build")
    df = B.build_silver(_sources(spark, d), _OPT, lambda f, name: W.write_stage(f, f"{root}/{name}"))
    df = W.write_stage(df, f"{root}/silver", ["data_subset"])
    paths = W.write_gold(df, f"{root}/gold", ts="ts")
    hot = spark.read.parquet(paths["one_hot"])
    return hot.groupBy("data_subset").agg(F.count("*").alias("rows"), F.sum("y").alias("load"),
                                          F.sum("max_ev").alias("chargers"), F.sum("temperature_2m").alias("warmth"),
                                          F.sum("Hour_5").alias("hour_5"))


@query("inference_run", with_("""h AS (SELECT event_type AS entity, date_trunc('hour', ts) AS ts, max(value) AS y FROM
  events GROUP BY 1, 2), h2 AS (SELECT entity, ts, CASE WHEN entity = 'click' THEN least(y, 150.0) ELSE y END AS y FROM h
  WHERE NOT (entity = 'view' AND ts < TIMESTAMP '2024-01-10')), f AS (SELECT entity, unnest(generate_series(TIMESTAMP
  '2024-01-31', TIMESTAMP '2024-02-01 23:00:00', INTERVAL 1 HOUR)) AS ts FROM (SELECT DISTINCT entity FROM h2))""",
                              body="""SELECT f.entity, f.ts, coalesce(a.y, 0) * 0.5 + 1 AS pred, (SELECT sum(value) FROM events e
  WHERE e.event_type = f.entity AND date_trunc('hour', e.ts) <= f.ts) AS max_ev FROM f LEFT JOIN h2 a
  ON a.entity = f.entity AND a.ts = f.ts - INTERVAL 48 HOUR"""), "pred max_ev")
def inference(spark, d):
    src = _sources(spark, d)
    frame = B.inference_frame(src, "2024-01-31", "2024-02-01 23:00:00", _OPT)
    from ..operators.grid import full_grid
    grid = full_grid(frame.select("entity", "ts", "y"), size=168)
    known = grid.withColumn("y", F.when(F.col("ts") < F.lit("2024-01-31").cast("timestamp_ntz"),
                                        F.coalesce("y", F.lit(0.0))))
    score = H.linear_scorer({"lag_48h": 0.5}, 1.0, lags=(48,), windows=(), diffs=(), size=168)
    return B.forecast_window(frame, lambda _: score(known), "2024-01-31", "2024-02-01 23:00:00", prices=("max_ev",))
