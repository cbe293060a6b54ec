"""Queries over the time grid: index, gaps, trimming, completion, filling, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as C
from ..functions import timezone as Z
from ..operators import grid as G
from ..sources import prices as P
from ..spec import PANEL
from . import fixtures as X
from .registry import query, with_

# Queries use short slabs, so that state crosses slab borders on small data too.
SLAB = 168

query("t1_index_from_origin", with_(X.S_USER, body="SELECT * FROM indexed"), "y")(X.user_indexed)


@query("t1_index_fixed_origin", with_(X.S_HOURLY, body="""SELECT entity, ts, y,
  date_diff('hour', TIMESTAMP '2023-12-31 23:00:00', ts) AS time_idx FROM hourly"""), "y")
def t1_fixed(spark, d):
    return G.index_from(X.hourly(spark, d), "2023-12-31 23:00:00")


@query("t2_index_by_entity", with_(X.S_USER, body="""SELECT entity, ts, y, date_diff('hour',
  min(ts) OVER (PARTITION BY entity), ts) AS time_idx FROM hourly"""), "y")
def t2(spark, d):
    return G.index_by_entity(X.user_hourly(spark, d))


_MISSING = """present AS (SELECT DISTINCT entity, time_idx FROM indexed),
  span AS (SELECT entity, unnest(generate_series(min(time_idx), max(time_idx))) AS time_idx
    FROM present GROUP BY entity),
  missing AS (SELECT s.entity, s.time_idx FROM span s ANTI JOIN present p
    ON s.entity = p.entity AND s.time_idx = p.time_idx)"""


@query("t3_missing_steps", with_(X.S_INDEXED, _MISSING, body="SELECT * FROM missing"))
def t3_steps(spark, d):
    return G.missing_steps(X.indexed(spark, d), size=SLAB)


@query("t3_missing_report", with_(X.S_INDEXED, _MISSING, body="""SELECT entity,
  count(*) AS missing_count, string_agg(CAST(time_idx AS VARCHAR), ',' ORDER BY time_idx)
  AS missing_time_idx FROM missing GROUP BY entity"""))
def t3_report(spark, d):
    r = G.missing_report(X.indexed(spark, d), size=SLAB)
    return r.withColumn("missing_time_idx", F.array_join(
        F.col("missing_time_idx").cast("array<string>"), ","))


@query("t3_missing_counts", with_(X.S_USER, body="""SELECT entity, max(time_idx) - min(time_idx) + 1
  - count(DISTINCT time_idx) AS missing_count FROM indexed GROUP BY entity"""))
def t3_counts(spark, d):
    return G.missing_counts(X.user_indexed(spark, d))


_STEPS = """steps AS (SELECT entity, time_idx, lag(time_idx) OVER (PARTITION BY entity
  ORDER BY time_idx) AS after FROM indexed)"""


@query("t4_gaps", with_(X.S_USER, _STEPS, body="""SELECT entity, after, time_idx AS "before",
  time_idx - after - 1 AS missing FROM steps WHERE time_idx - after > 1"""))
def t4_gaps(spark, d):
    return G.gaps(X.user_indexed(spark, d), size=SLAB)


@query("t4_last_gap", with_(X.S_USER, _STEPS, body="""SELECT entity, count(*) AS n_gaps,
  max(time_idx) AS block_start FROM steps WHERE time_idx - after > 1 GROUP BY entity"""))
def t4_last(spark, d):
    return G.last_gap(X.user_indexed(spark, d), size=SLAB)


_TAIL = """flags AS (SELECT *, coalesce(time_idx - after > 1, true) AS s FROM steps),
  tail AS (SELECT entity, max(time_idx) - min(time_idx) + 1 - count(*) AS missing_count,
    max(CASE WHEN s THEN time_idx END) AS block_start, max(time_idx) AS last_idx
    FROM flags GROUP BY entity),
  plan AS (SELECT entity, missing_count, block_start, CASE WHEN missing_count <= {m} THEN 'keep'
    WHEN floor((last_idx - block_start) / 24.0) < {days} THEN 'drop' ELSE 'trim' END AS decision FROM tail)"""


@query("t5_tail_blocks", with_(X.S_INDEXED, _STEPS, _TAIL.format(m=3, days=1),
                               body="SELECT * FROM plan"))
def t5_plan(spark, d):
    return G.tail_blocks(X.indexed(spark, d), min_days=1, size=SLAB)


@query("t5_trim_to_tail", with_(X.S_INDEXED, _STEPS, _TAIL.format(m=3, days=0), body="""SELECT i.*
  FROM indexed i JOIN plan p ON p.entity = i.entity WHERE decision <> 'drop'
  AND (decision = 'keep' OR i.time_idx >= block_start)"""), "y")
def t5_trim(spark, d):
    return G.trim_to_tail(X.indexed(spark, d), min_days=0, size=SLAB)


@query("t5_trim_summary", with_(X.S_USER, _STEPS, _TAIL.format(m=100, days=0), body="""SELECT
  decision, count(*) AS entities FROM plan GROUP BY 1"""))
def t5_summary(spark, d):
    return G.trim_summary(X.user_indexed(spark, d), max_missing=100, min_days=0, size=SLAB)


@query("t5_blocks", with_(X.S_USER, _STEPS, """flags AS (SELECT *, sum(CASE WHEN time_idx - after > 1
  THEN 1 ELSE 0 END) OVER (PARTITION BY entity ORDER BY time_idx) AS b FROM steps)""",
                          body="""SELECT entity, min(time_idx) AS first_idx, max(time_idx) AS last_idx,
  max(time_idx) - min(time_idx) + 1 AS steps FROM flags GROUP BY entity, b"""))
def t5_blocks(spark, d):
    return G.blocks(X.user_indexed(spark, d), size=SLAB)


@query("t6_keep_first", """SELECT entity, ts, y, event_id FROM (SELECT event_type AS entity,
  date_trunc('hour', ts) AS ts, value AS y, event_id, row_number() OVER (PARTITION BY event_type,
  date_trunc('hour', ts) ORDER BY value, event_id) AS rn FROM events) WHERE rn = 1""", "y")
def t6_first(spark, d):
    e = X.readings(spark, d).select("entity", F.date_trunc("hour", "ts").alias("ts"), "y", "event_id")
    return G.deduplicate(e, ["entity", "ts"], [F.col("y"), F.col("event_id")])


@query("t6_keep_last", """SELECT entity, ts, y, event_id FROM (SELECT user_id AS entity,
  date_trunc('day', ts) AS ts, value AS y, event_id, row_number() OVER (PARTITION BY user_id,
  date_trunc('day', ts) ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1""", "y")
def t6_last(spark, d):
    e = X.readings(spark, d).select(F.col("user_id").alias("entity"),
                                    F.date_trunc("day", "ts").alias("ts"), "y", "event_id")
    return G.deduplicate(e, ["entity", "ts"], [F.col("event_id")], keep="last")


@query("t7_full_grid", with_(X.S_GRID, body="SELECT entity, ts, y, time_idx FROM grid"), "y")
def t7(spark, d):
    return G.full_grid(X.hourly(spark, d), size=SLAB)


@query("t7_full_grid_users", with_(X.S_USER, body="""SELECT c.entity, c.ts, h.y, date_diff('hour',
  (SELECT min(ts) FROM hourly), c.ts) AS time_idx FROM (SELECT entity, unnest(generate_series(
  min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM hourly GROUP BY entity) c
  LEFT JOIN hourly h ON h.entity = c.entity AND h.ts = c.ts"""), "y")
def t7_users(spark, d):
    return G.full_grid(X.user_hourly(spark, d), size=SLAB)


_LONGEST = """runs AS (SELECT entity, CAST(sum(time_idx - after - 1) AS BIGINT) AS missing_count,
  max(time_idx - after - 1) AS longest_gap FROM steps WHERE after IS NOT NULL GROUP BY entity)"""


@query("t8_longest_gaps", with_(X.S_INDEXED, _STEPS, _LONGEST, body="""SELECT entity,
  missing_count, longest_gap, CASE WHEN missing_count = 0 THEN 'OK' WHEN longest_gap > 1
  THEN 'DROP' ELSE 'FILL' END AS action FROM runs"""))
def t8(spark, d):
    return G.longest_gaps(X.indexed(spark, d), size=SLAB)


@query("t8_longest_gaps_users", with_(X.S_USER, _STEPS, _LONGEST, body="""SELECT entity,
  coalesce(missing_count, 0) AS missing_count, coalesce(longest_gap, 0) AS longest_gap,
  CASE WHEN coalesce(missing_count, 0) = 0 THEN 'OK' WHEN longest_gap > 100 THEN 'DROP' ELSE 'FILL'
  END AS action FROM (SELECT DISTINCT entity FROM indexed) LEFT JOIN runs USING (entity)"""))
def t8_users(spark, d):
    return G.longest_gaps(X.user_indexed(spark, d), max_gap=100, size=SLAB)


_NEAR = """around AS (SELECT g.*,
  last_value(y IGNORE NULLS) OVER p AS pv, last_value(CASE WHEN y IS NOT NULL THEN time_idx END
    IGNORE NULLS) OVER p AS pt,
  first_value(y IGNORE NULLS) OVER n AS nv, first_value(CASE WHEN y IS NOT NULL THEN time_idx END
    IGNORE NULLS) OVER n AS nt
  FROM {src} g WINDOW p AS (PARTITION BY entity ORDER BY time_idx ROWS UNBOUNDED PRECEDING),
  n AS (PARTITION BY entity ORDER BY time_idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
  filled AS (SELECT entity, ts, time_idx, coalesce(y, pv + (nv - pv) * (time_idx - pt)
    / nullif(nt - pt, 0), pv) AS y, pv, nv FROM around)"""
# Every 5th user starts and ends with unknown values and every 7th has none at all.
_HOLES = """holes AS (SELECT c.entity, c.ts, date_diff('hour', (SELECT min(ts) FROM hourly), c.ts)
  AS time_idx, CASE WHEN c.entity % 7 = 0 OR (c.entity % 5 = 0 AND (c.ts = c.a OR c.ts = c.b))
  THEN NULL ELSE h.y END AS y FROM (SELECT entity, min(ts) AS a, max(ts) AS b, unnest(generate_series(
  min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM hourly GROUP BY entity) c
  LEFT JOIN hourly h ON h.entity = c.entity AND h.ts = c.ts)"""


def _holes(spark, d):
    g = G.full_grid(X.user_hourly(spark, d), size=SLAB)
    ends = g.groupBy("entity").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    unknown = (F.col("entity") % 7 == 0) | ((F.col("entity") % 5 == 0)
                                            & (F.col("ts").isin(F.col("a"), F.col("b"))))
    return g.join(ends, "entity").select("entity", "ts", "time_idx",
                                         F.when(~unknown, F.col("y")).alias("y"))


@query("t9_interpolate", with_(X.S_GRID, _NEAR.format(src="grid"), body="""SELECT entity, ts,
  time_idx, y FROM filled"""), "y")
def t9(spark, d):
    return G.interpolate(X.full(spark, d), ["y"], size=SLAB)


@query("t9_interpolate_users", with_(X.S_USER, _HOLES, _NEAR.format(src="holes"), body="""SELECT
  entity, ts, time_idx, y FROM filled"""), "y")
def t9_users(spark, d):
    return G.interpolate(_holes(spark, d), ["y"], size=SLAB)


@query("t10_interpolate_both_ends", with_(X.S_USER, _HOLES, _NEAR.format(src="holes"),
                                          body="""SELECT entity, ts, time_idx,
  coalesce(y, nv, 0.0) AS y FROM filled"""), "y")
def t10(spark, d):
    return G.interpolate(_holes(spark, d), ["y"], both_ends=True, size=SLAB)


@query("t11_fill_both_ways", with_(X.S_USER, _HOLES, _NEAR.format(src="holes"), body="""SELECT
  entity, ts, time_idx, coalesce(h.y, pv, nv) AS y FROM around h"""), "y")
def t11(spark, d):
    return G.fill_both_ways(_holes(spark, d), ["y"], size=SLAB)


@query("t12_fill_prices_in_time", with_(X.S_PRICES, """span AS (SELECT unnest(generate_series(
  min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM prices), sparse AS (SELECT s.ts,
  CASE WHEN extract(hour FROM s.ts) NOT IN (3, 4) THEN dam_price END AS dam_price
  FROM span s LEFT JOIN prices p ON p.ts = s.ts)""", body="""SELECT ts, date_diff('hour',
  min(ts) OVER (), ts) AS time_idx, last_value(dam_price IGNORE NULLS) OVER (ORDER BY ts
  ROWS UNBOUNDED PRECEDING) AS dam_price FROM sparse"""), "dam_price")
def t12(spark, d):
    p = X.prices(spark, d).select("ts", F.when(~F.hour("ts").isin(3, 4), F.col("dam_price"))
                                  .alias("dam_price"))
    return G.complete_time_table(p, PANEL, ["dam_price"], SLAB)


@query("t13_extend_grid", with_(X.S_HOURLY, """span AS (SELECT entity, unnest(generate_series(
  TIMESTAMP '2024-01-20', TIMESTAMP '2024-02-02 23:00:00', INTERVAL 1 HOUR)) AS ts
  FROM (SELECT DISTINCT entity FROM hourly))""", body="""SELECT entity, ts, y FROM hourly UNION ALL
  SELECT s.entity, s.ts, NULL AS y FROM span s ANTI JOIN hourly h ON s.entity = h.entity
  AND s.ts = h.ts"""), "y")
def t13(spark, d):
    return G.extend(X.hourly(spark, d), "2024-01-20", "2024-02-02 23:00:00")


@query("t14_forecast_window", """SELECT event_type AS entity, date_trunc('hour', max(ts)
  + INTERVAL 1 HOUR) AS origin, CAST(date_trunc('month', max(ts)) + INTERVAL 1 MONTH AS TIMESTAMP)
  AS window_start, CAST(date_trunc('month', max(ts)) + INTERVAL 2 MONTH - INTERVAL 1 HOUR
  AS TIMESTAMP) AS window_end FROM events GROUP BY 1""")
def t14(spark, d):
    last = X.readings(spark, d).groupBy("entity").agg(F.max("ts").alias("last"))
    a, b = C.next_month_window("last")
    return last.select("entity", C.next_origin("last").alias("origin"), a.alias("window_start"),
                       b.alias("window_end"))


# Order dates with an hour from the key are local stamps through every clock change.
_LOCAL = """stamps AS (SELECT o_orderkey, o_orderdate + (o_orderkey % 24) * INTERVAL 1 HOUR
  + INTERVAL 30 MINUTE AS local FROM orders),
  pair AS (SELECT *, local AT TIME ZONE 'Europe/Kyiv' AT TIME ZONE 'UTC' AS u FROM stamps),
  flags AS (SELECT *, (u AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Kyiv') <> local AS skipped,
   ((u - INTERVAL 1 HOUR) AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Kyiv') = local AS earlier,
   ((u + INTERVAL 1 HOUR) AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Kyiv') = local AS later FROM pair)"""


def _stamps(spark, d):
    o = X.table(spark, d, "orders")
    local = C.add_steps(F.col("o_orderdate"), F.col("o_orderkey") % 24) + F.expr("interval 30 minutes")
    return o.select("o_orderkey", local.alias("local"))


@query("t15_local_to_utc", with_(_LOCAL, body="""SELECT o_orderkey, local,
  CASE WHEN skipped THEN date_trunc('hour', u) WHEN earlier THEN u - INTERVAL 1 HOUR ELSE u END
    AS utc_earliest,
  CASE WHEN skipped THEN NULL WHEN later THEN u + INTERVAL 1 HOUR ELSE u END AS utc_latest,
  CASE WHEN skipped OR earlier OR later THEN NULL ELSE u END AS utc_strict FROM flags"""))
def t15(spark, d):
    z = "Europe/Kyiv"
    return _stamps(spark, d).select(
        "o_orderkey", "local", Z.to_utc("local", z).alias("utc_earliest"),
        Z.to_utc("local", z, "latest", "null").alias("utc_latest"),
        Z.to_utc("local", z, "null", "null").alias("utc_strict"))


@query("t15_utc_to_local", """SELECT o_orderkey, date_trunc('hour', u AT TIME ZONE 'UTC'
  AT TIME ZONE 'Europe/Kyiv') AS local FROM (SELECT o_orderkey, o_orderdate + (o_orderkey % 24)
  * INTERVAL 1 HOUR + INTERVAL 30 MINUTE AS u FROM orders)""")
def t15_back(spark, d):
    return _stamps(spark, d).select("o_orderkey", Z.floor_hour(Z.to_local("local", "Europe/Kyiv"))
                                    .alias("local"))


# A price report as it lands: a date line, then lines 1..24; one report per month.

def _report(spark, d):
    p = X.prices(spark, d)
    base = p.select(F.date_format("ts", "yyyy-MM").alias("file"), F.to_date("ts").alias("day"),
                    F.hour("ts").alias("h"), "dam_price", "sell_bm_price", "buy_bm_price")
    hours = base.select("file", (F.datediff("day", F.lit("1990-01-01")) * 25 + F.col("h") + 1)
                        .cast("long").alias("line"), (F.col("h") + 1).cast("string").alias("label"),
                        "dam_price", "sell_bm_price", "buy_bm_price")
    none = F.lit(None).cast("double")
    dates = base.groupBy("file", "day").agg(F.count("*").alias("n")).select(
        "file", (F.datediff("day", F.lit("1990-01-01")) * 25).cast("long").alias("line"),
        F.col("day").cast("string").alias("label"), none.alias("dam_price"),
        none.alias("sell_bm_price"), none.alias("buy_bm_price"))
    return hours.unionByName(dates)


@query("t16_report_to_hours", with_(X.S_PRICES, body="""SELECT ts, dam_price, sell_bm_price,
  buy_bm_price FROM prices"""), "dam_price sell_bm_price buy_bm_price")
def t16(spark, d):
    return P.report_to_hours(_report(spark, d), "file", "line", "label",
                             ["dam_price", "sell_bm_price", "buy_bm_price"], size=100)


_SPLIT = """labelled AS (SELECT *, CASE WHEN ts < TIMESTAMP '2000-07-01' THEN 'train' WHEN ts <
  TIMESTAMP '2001-01-01' THEN 'val' ELSE 'test' END AS data_subset FROM daily)"""


def labelled(spark, d):
    return G.label_splits(X.daily(spark, d), "2000-07-01", "2001-01-01")


query("t17_label_splits", with_(X.S_DAILY, _SPLIT, body="SELECT * FROM labelled"), "y", 2)(labelled)


@query("t18_split_cutoffs", with_(X.S_DAILY, _SPLIT, body="""SELECT data_subset, date_diff('day',
  (SELECT min(ts) FROM daily), max(ts)) AS cutoff FROM labelled GROUP BY 1"""))
def t18(spark, d):
    return G.split_cutoffs(G.index_from(labelled(spark, d), spec=X.DAILY), X.DAILY)


@query("t18_reslice", with_(X.S_DAILY, _SPLIT, body="""SELECT entity, ts, data_subset, date_diff('day',
  (SELECT min(ts) FROM daily), ts) AS time_idx FROM labelled"""))
def t18_reslice(spark, d):
    df = G.index_from(labelled(spark, d), spec=X.DAILY)
    return G.reslice(df.drop("data_subset"), G.split_cutoffs(df, X.DAILY), X.DAILY).drop("y")


@query("t19_stitch_context", with_(X.S_DAILY, _SPLIT, body="""SELECT entity, ts, y, data_subset, true
  AS is_context FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY ts DESC) AS rn FROM
  labelled WHERE data_subset = 'train' AND entity IN (SELECT entity FROM labelled WHERE
  data_subset = 'val')) WHERE rn <= 10 UNION ALL SELECT entity, ts, y, data_subset, false
  FROM labelled WHERE data_subset = 'val'"""), "y", 2)
def t19(spark, d):
    df = labelled(spark, d)
    return G.stitch_context(df.filter("data_subset = 'train'"), df.filter("data_subset = 'val'"), 10)


@query("t20_contiguous_lookback", with_(X.S_INDEXED, body="""SELECT entity, ts, y, time_idx,
  count(*) OVER (PARTITION BY entity ORDER BY time_idx RANGE BETWEEN 24 PRECEDING AND 1 PRECEDING)
  = 24 AS contiguous FROM indexed"""), "y")
def t20(spark, d):
    return G.contiguous_lookback(X.indexed(spark, d), 24, size=SLAB)


@query("d14_init_unknown", with_(X.S_GRID, body="""SELECT entity, ts, y, time_idx, coalesce(y,
  avg(y) OVER (PARTITION BY entity), 0.0) AS y_init FROM grid"""), "y y_init")
def d14(spark, d):
    return G.init_unknown(X.full(spark, d))


@query("d14_placeholder_fill", with_(X.S_USER, _HOLES, _NEAR.format(src="holes"), body="""SELECT
  entity, ts, time_idx, coalesce(h.y, pv, nv, 0.0) AS y FROM around h"""), "y")
def d14_fill(spark, d):
    return G.placeholder_fill(_holes(spark, d), size=SLAB)
