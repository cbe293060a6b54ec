"""Queries over joins with dimensions, dated facts, prices, weather, alarms, neighbours."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.geo import great_circle
from ..operators import grid as G
from ..operators import joins as J
from ..sources import payloads
from . import clean as Q
from . import fixtures as X
from .registry import query, with_


@query("c1_dimension_join", """SELECT s_suppkey, s_name, s_nationkey AS n_nationkey, s_name || '!' AS
  n_name, n_name AS n_name_dict, n_regionkey FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""")
def c1(spark, d):
    s = X.table(spark, d, "supplier").select("s_suppkey", "s_name", F.col("s_nationkey").alias(
        "n_nationkey"), F.concat("s_name", F.lit("!")).alias("n_name"))
    return J.with_dimension(s, X.table(spark, d, "nation"), ["n_nationkey"])


def _customer_stamps(spark, d):
    """Order stamps of each customer, six hours after midnight."""
    o = X.table(spark, d, "orders")
    return o.select(F.col("o_custkey").alias("entity"),
                    (F.col("o_orderdate") + F.expr("interval 6 hours")).alias("ts")).distinct()


_STAMPS = """stamps AS (SELECT DISTINCT o_custkey AS entity, o_orderdate + INTERVAL 6 HOUR AS ts
  FROM orders)"""


@query("c2_effective_value", with_(_STAMPS, """inst AS (SELECT o_custkey AS entity, min(o_orderdate)
  AS since, max(o_totalprice) AS power FROM orders GROUP BY 1)""", body="""SELECT s.entity, ts,
  CASE WHEN CAST(ts AS DATE) > CAST(since AS DATE) THEN power ELSE 0.0 END AS max_solar
  FROM stamps s LEFT JOIN inst i ON s.entity = i.entity AND s.entity % 4 <> 0"""), "max_solar")
def c2(spark, d):
    one = X.installs(spark, d).filter("entity % 4 <> 0").groupBy("entity").agg(
        F.min("start").alias("since"), F.max("power").alias("power"))
    return J.effective_value(_customer_stamps(spark, d), one, "since", "power")


@query("c3_effective_sum", with_(X.S_MONTHS, body="""SELECT m.entity, m.ts, coalesce(sum(o_totalprice), 0)
  AS max_ev FROM months m LEFT JOIN orders ON o_custkey = m.entity AND o_orderdate <= m.ts
  GROUP BY 1, 2"""), "max_ev", 2)
def c3(spark, d):
    return J.effective_sum(X.customer_months(spark, d), X.installs(spark, d), "start", "power",
                           slab_days=200)


@query("c3_effective_sum_small_side", with_(X.S_HOURLY, """inst AS (SELECT event_type AS entity,
  date_trunc('day', ts) AS start, count(*) AS power FROM events GROUP BY 1, 2)""",
                                            body="""SELECT h.entity, h.ts, h.y, CAST(coalesce((SELECT
  sum(power) FROM inst i WHERE i.entity = h.entity AND i.start <= h.ts), 0) AS DOUBLE) AS max_ev
  FROM hourly h"""), "y max_ev")
def c3_small(spark, d):
    inst = X.readings(spark, d).groupBy("entity", F.date_trunc("day", "ts").alias("start")).agg(
        F.count("*").cast("double").alias("power"))
    return J.effective_sum(X.hourly(spark, d), inst, "start", "power")


@query("c4_translate_key", """SELECT n_name AS eic_code, s_suppkey, s_acctbal FROM supplier JOIN nation
  ON s_nationkey = n_nationkey WHERE n_nationkey % 5 <> 0 AND s_suppkey % 7 <> 0""", "s_acctbal")
def c4(spark, d):
    s = X.table(spark, d, "supplier").select(
        F.col("s_nationkey").alias("code"), "s_suppkey",
        F.when(F.col("s_suppkey") % 7 != 0, F.col("s_acctbal")).alias("s_acctbal"))
    bridge = X.table(spark, d, "nation").select(F.col("n_nationkey").alias("code"), F.when(
        F.col("n_nationkey") % 5 != 0, F.col("n_name")).alias("eic_code"))
    return J.translate_key(s, bridge, "code", "eic_code")


@query("c5_prices_by_time", with_(X.S_USER, X.S_PRICES, body="""SELECT entity, h.ts, y, dam_price,
  sell_bm_price, buy_bm_price FROM hourly h LEFT JOIN prices p ON h.ts = p.ts"""),
       "y dam_price sell_bm_price buy_bm_price")
def c5(spark, d):
    return J.with_prices(X.user_hourly(spark, d), X.prices(spark, d))


@query("c6_fill_weather", with_(X.S_STATIONS, """obs AS (SELECT l_suppkey AS entity, l_shipdate AS ts,
  sum(l_quantity) AS y, CASE WHEN l_suppkey % 2 = 0 THEN 7.5 END AS rain FROM lineitem GROUP BY 1, 2),
  weather AS (SELECT l_shipdate AS ts, l_suppkey, max(l_orderkey * 10 + l_linenumber) AS ord,
    max(l_extendedprice) AS t, max(l_tax) AS r FROM lineitem GROUP BY 1, 2)""",
                                body="""SELECT o.entity, o.ts, y, t AS temperature_2m, coalesce(o.rain, r) AS rain
  FROM obs o JOIN stations s ON s.entity = o.entity LEFT JOIN (SELECT ts, latitude, longitude,
  max_by(t, ord) AS t, max_by(r, ord) AS r FROM weather w JOIN stations z ON z.entity = w.l_suppkey
  GROUP BY ALL) w ON w.ts = o.ts AND w.latitude = s.latitude AND w.longitude = s.longitude"""),
       "y temperature_2m rain")
def c6(spark, d):
    st = X.stations(spark, d).select("entity", "latitude", "longitude")
    obs = X.supplier_daily(spark, d).join(st, "entity").withColumn(
        "rain", F.when(F.col("entity") % 2 == 0, 7.5))
    li = X.table(spark, d, "lineitem")
    w = (li.groupBy(F.col("l_suppkey").alias("entity"), F.col("l_shipdate").alias("ts"))
         .agg(F.max(F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"),
              F.max("l_extendedprice").alias("temperature_2m"), F.max("l_tax").alias("rain"))
         .join(st, "entity")
         .select("ts", (F.col("latitude") + 1e-9).alias("latitude"), "longitude", "ord",
                 "temperature_2m", "rain"))
    return J.fill_weather(obs, w, ["temperature_2m", "rain"], order="ord").drop("latitude", "longitude")


@query("c7_lacking", with_(X.S_USER, body="""SELECT * EXCLUDE (time_idx) FROM indexed WHERE entity NOT IN
  (SELECT user_id FROM events WHERE value > 200)"""), "y")
def c7(spark, d):
    done = X.table(spark, d, "events").filter("value > 200").select(F.col("user_id").alias("entity"))
    return J.lacking(X.user_hourly(spark, d), done, ["entity"])


@query("c8_spine", """SELECT u AS entity, unnest(generate_series(TIMESTAMP '2024-02-01', TIMESTAMP
  '2024-02-02 23:00:00', INTERVAL 1 HOUR)) AS ts FROM (SELECT DISTINCT user_id AS u FROM events)""")
def c8(spark, d):
    users = X.table(spark, d, "events").select(F.col("user_id").alias("entity"))
    return G.spine(users, "2024-02-01", "2024-02-02 23:00:00")


@query("c9_attach_actuals", with_(X.s_forecasts(), body="""SELECT entity, time_idx, pred, y, dam_price
  FROM forecasts"""), "pred y dam_price")
def c9(spark, d):
    f = X.forecasts(spark, d)
    copies = f.unionByName(f)
    return J.attach_actuals(f.select("entity", "time_idx", "pred"), copies, ["entity", "time_idx"],
                            ["y", "dam_price"])


@query("c10_semi_join", """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey
  FROM customer WHERE c_mktsegment = 'MACHINERY')""")
def c10(spark, d):
    c = X.table(spark, d, "customer").filter("c_mktsegment = 'MACHINERY'").select(
        F.col("c_custkey").alias("o_custkey"))
    return J.semi(X.table(spark, d, "orders"), c, ["o_custkey"]).select("o_orderkey", "o_custkey")


_GREAT = """2 * 6371.0088 * asin(sqrt(least(1.0, pow(sin((radians({b}.latitude) - radians({a}.latitude)) / 2), 2)
  + cos(radians({a}.latitude)) * cos(radians({b}.latitude))
  * pow(sin((radians({b}.longitude) - radians({a}.longitude)) / 2), 2))))"""
_NEAREST = "pairs AS (SELECT a.entity AS src, b.entity AS dst, round(" + _GREAT.format(a="a", b="b") + """, 6)
  AS distance FROM stations a JOIN stations b ON a.entity <> b.entity),
  nearest AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY distance, dst) AS rank
  FROM pairs QUALIFY rank <= 5),
  sym AS (SELECT src, dst FROM nearest UNION SELECT dst, src FROM nearest UNION SELECT src, src FROM nearest),
  edges AS (SELECT src, dst, 1.0 / count(*) OVER (PARTITION BY dst) AS weight FROM sym)"""


def _nearest(spark, d):
    return J.nearest(X.stations(spark, d), "entity", "latitude", "longitude", 5)


@query("c11_nearest_neighbours", with_(X.S_STATIONS, _NEAREST, body="""SELECT src, dst,
  CAST(rank AS INTEGER) AS rank, distance FROM nearest"""), "distance", 3)
def c11(spark, d):
    return _nearest(spark, d)


@query("c11_neighbour_graph", with_(X.S_STATIONS, _NEAREST, body="SELECT * FROM edges"), "weight")
def c11_graph(spark, d):
    return J.neighbour_graph(_nearest(spark, d))


@query("c12_neighbour_mean", with_(X.S_STATIONS, _NEAREST, X.S_SUPPLIER, body="""SELECT dst AS entity, ts,
  sum(weight * y) AS y_near FROM sdaily JOIN edges ON src = entity GROUP BY 1, 2"""), "y_near")
def c12(spark, d):
    return J.neighbour_mean(X.supplier_daily(spark, d), J.neighbour_graph(_nearest(spark, d)), ["y"])


@query("c13_alarm_hours", with_(Q.S_ALARMS, """spans AS (SELECT region_id, start, "end" - INTERVAL 1 SECOND AS
  final FROM alarm_rows WHERE "end" > start), seconds AS (SELECT DISTINCT region_id, unnest(generate_series(
  start, final, INTERVAL 1 SECOND)) AS s FROM spans), under AS (SELECT region_id, date_trunc('hour', s) AS ts,
  count(*) / 60.0 AS minutes FROM seconds GROUP BY 1, 2), met AS (SELECT region_id, unnest(generate_series(
  date_trunc('hour', start), date_trunc('hour', final), INTERVAL 1 HOUR)) AS ts FROM spans)""",
                                body="""SELECT m.region_id, m.ts, count(*) AS alarms, any_value(minutes) AS minutes
  FROM met m JOIN under u ON u.region_id = m.region_id AND u.ts = m.ts GROUP BY 1, 2"""), "minutes")
def c13(spark, d):
    return J.alarm_hours(payloads.alarm_rows(Q._alarms(spark, d), "payload"))


@query("c14_requirement_spans", """SELECT 'R' || user_id AS region_name, min(ts) AS start, max(ts) AS "end",
  CASE WHEN user_id % 2 = 0 THEN CAST(user_id AS VARCHAR) END AS region_id FROM events GROUP BY user_id""")
def c14(spark, d):
    e = X.table(spark, d, "events").select(F.concat(F.lit("R"), "user_id").alias("region_name"), "ts",
                                           "user_id")
    ids = e.filter("user_id % 2 = 0").select("region_name", F.col("user_id").cast("string")
                                             .alias("region_id")).distinct()
    return J.requirement_spans(e, "region_name", ids)


@query("f16_great_circle", with_(X.S_STATIONS, body="SELECT b.entity, " + _GREAT.format(a="a", b="b") + """
  AS km FROM stations b JOIN stations a ON a.entity = b.entity // 2"""), "km", 3)
def f16(spark, d):
    s = X.stations(spark, d)
    o = s.select(F.col("entity").alias("o"), F.col("latitude").alias("lat0"), F.col("longitude").alias("lon0"))
    return s.join(o, F.floor(F.col("entity") / 2) == F.col("o")).select(
        "entity", great_circle("lat0", "lon0", "latitude", "longitude").alias("km"))
