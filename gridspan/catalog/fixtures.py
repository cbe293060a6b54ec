"""Panels derived from the given tables, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features, grid
from ..spec import PANEL

DAILY = PANEL.with_(step_seconds=86400)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def readings(spark, folder) -> DataFrame:
    """Events as meter readings of any density."""
    return table(spark, folder, "events").select(
        F.col("event_type").alias("entity"), "ts", F.col("value").alias("y"), "user_id", "event_id")


def hourly(spark, folder) -> DataFrame:
    """One row per event type and hour."""
    return grid.hourly_sum(readings(spark, folder), "y")


def indexed(spark, folder) -> DataFrame:
    return grid.index_from(hourly(spark, folder))


def full(spark, folder) -> DataFrame:
    return grid.full_grid(hourly(spark, folder))


def user_hourly(spark, folder) -> DataFrame:
    """A sparse panel: one row per user and hour."""
    e = readings(spark, folder)
    return grid.hourly_sum(e.select(F.col("user_id").alias("entity"), "ts", "y"), "y")


def user_indexed(spark, folder) -> DataFrame:
    return grid.index_from(user_hourly(spark, folder))


def prices(spark, folder) -> DataFrame:
    """Three market prices per hour."""
    e = table(spark, folder, "events")
    dam = 1000 + 10 * F.avg("value")
    return (e.groupBy(F.date_trunc("hour", "ts").alias("ts")).agg(dam.alias("dam_price"))
            .select("ts", "dam_price", (F.col("dam_price") * 0.7).alias("sell_bm_price"),
                    (F.col("dam_price") * 1.3).alias("buy_bm_price")))


def forecasts(spark, folder, lag: int = 48) -> DataFrame:
    """Evaluation frame: actual, the value ``lag`` hours ago, prices."""
    g = features.lag_columns(full(spark, folder), [lag], size=336)
    f = g.withColumnRenamed(f"lag_{lag}", "pred").dropna(subset=["y", "pred"])
    return f.join(prices(spark, folder), "ts", "inner")


def daily(spark, folder) -> DataFrame:
    """Years of daily history: order value per nation and day."""
    o, c = table(spark, folder, "orders"), table(spark, folder, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey)
    return (j.groupBy(F.col("c_nationkey").alias("entity"), F.col("o_orderdate").alias("ts"))
            .agg(F.sum("o_totalprice").alias("y")))


def supplier_daily(spark, folder) -> DataFrame:
    """The larger panel: shipped quantity per supplier and day."""
    li = table(spark, folder, "lineitem")
    return (li.groupBy(F.col("l_suppkey").alias("entity"), F.col("l_shipdate").alias("ts"))
            .agg(F.sum("l_quantity").alias("y")))


def installs(spark, folder) -> DataFrame:
    o = table(spark, folder, "orders")
    return o.select(F.col("o_custkey").alias("entity"), F.col("o_orderdate").alias("start"),
                    F.col("o_totalprice").alias("power"))


def customer_months(spark, folder) -> DataFrame:
    """Customers at the month starts of the order history."""
    o = table(spark, folder, "orders")
    months = o.agg(F.trunc(F.min("o_orderdate"), "month").alias("a"),
                   F.trunc(F.max("o_orderdate"), "month").alias("b"))
    c = table(spark, folder, "customer").select(F.col("c_custkey").alias("entity"))
    seq = F.sequence(months.select("a").scalar(), months.select("b").scalar(),
                     F.expr("interval 1 month"))
    # A small file of customers becomes many rows, which one task should not make alone.
    c = c.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    return c.select("entity", F.explode(seq).alias("m")).select(
        "entity", F.col("m").cast("timestamp_ntz").alias("ts"))


def stations(spark, folder) -> DataFrame:
    """Suppliers as stations with coordinates; every 9th one lacks them."""
    s = table(spark, folder, "supplier")
    k = F.col("s_suppkey")
    return s.select(k.alias("entity"), F.col("s_nationkey").alias("region_id"),
                    (44 + (k * 37 % 801) / 100).alias("latitude"),
                    (22 + (k * 53 % 1801) / 100).alias("longitude"))


# --- the same panels in SQL ---------------------------------------------------------------

S_HOURLY = """hourly AS (SELECT event_type AS entity, date_trunc('hour', ts) AS ts, sum(value) AS y
  FROM events GROUP BY 1, 2)"""
S_INDEXED = S_HOURLY + """, indexed AS (SELECT entity, ts, y,
  date_diff('hour', (SELECT min(ts) FROM hourly), ts) AS time_idx FROM hourly)"""
S_GRID = S_INDEXED + """, bounds AS (SELECT entity, min(ts) AS a, max(ts) AS b FROM hourly GROUP BY 1),
  cells AS (SELECT entity, unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS ts FROM bounds),
  grid AS (SELECT c.entity, c.ts, h.y,
    date_diff('hour', (SELECT min(ts) FROM hourly), c.ts) AS time_idx
    FROM cells c LEFT JOIN hourly h ON h.entity = c.entity AND h.ts = c.ts)"""
S_USER = """hourly AS (SELECT user_id AS entity, date_trunc('hour', ts) AS ts, sum(value) AS y
  FROM events GROUP BY 1, 2), indexed AS (SELECT entity, ts, y,
  date_diff('hour', (SELECT min(ts) FROM hourly), ts) AS time_idx FROM hourly)"""
S_PRICES = """dam AS (SELECT date_trunc('hour', ts) AS ts, 1000 + 10 * avg(value) AS dam_price
  FROM events GROUP BY 1), prices AS (SELECT ts, dam_price, dam_price * 0.7 AS sell_bm_price,
  dam_price * 1.3 AS buy_bm_price FROM dam)"""


def s_forecasts(lag: int = 48) -> str:
    return S_GRID + ", " + S_PRICES + f""", lagged AS (SELECT *, lag(y, {lag}) OVER
  (PARTITION BY entity ORDER BY ts) AS pred FROM grid),
  forecasts AS (SELECT l.ts, entity, y, time_idx, pred, dam_price, sell_bm_price, buy_bm_price
  FROM lagged l JOIN prices p ON p.ts = l.ts WHERE y IS NOT NULL AND pred IS NOT NULL)"""


S_DAILY = """daily AS (SELECT c_nationkey AS entity, o_orderdate AS ts, sum(o_totalprice) AS y
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""
S_SUPPLIER = """sdaily AS (SELECT l_suppkey AS entity, l_shipdate AS ts, sum(l_quantity) AS y
  FROM lineitem GROUP BY 1, 2)"""
S_STATIONS = """stations AS (SELECT s_suppkey AS entity, s_nationkey AS region_id,
  44 + (s_suppkey * 37 % 801) / 100.0 AS latitude, 22 + (s_suppkey * 53 % 1801) / 100.0 AS longitude
  FROM supplier)"""
S_MONTHS = """months AS (SELECT c_custkey AS entity, unnest(generate_series(
  (SELECT date_trunc('month', min(o_orderdate)) FROM orders)::TIMESTAMP,
  (SELECT date_trunc('month', max(o_orderdate)) FROM orders)::TIMESTAMP, INTERVAL 1 MONTH)) AS ts
  FROM customer)"""
