"""Queries over aggregations and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean as K
from ..operators import grid as G
from ..operators import stats as S
from ..plans.quantiles import exact_quantiles
from ..spec import PANEL
from . import fixtures as X
from .registry import query, with_


@query("e1_coverage", with_(X.S_USER, body="""SELECT entity, min(ts) AS start, max(ts) AS "end", count(*)
  AS rows, min(ts) <= (SELECT min(ts) FROM hourly) AND max(ts) >= (SELECT max(ts) FROM hourly)
  AS full_span FROM hourly GROUP BY entity"""))
def e1(spark, d):
    return S.coverage(X.user_hourly(spark, d))


@query("e1_coverage_share", with_(X.S_HOURLY, body="""SELECT count(*) AS entities, count(*) FILTER (f) AS "full",
  avg(CAST(f AS DOUBLE)) * 100 AS full_span_pct FROM (SELECT min(ts) <= (SELECT min(ts) FROM hourly) AND
  max(ts) >= (SELECT max(ts) FROM hourly) AS f FROM hourly GROUP BY entity)"""), "full_span_pct")
def e1_share(spark, d):
    return S.coverage_share(X.hourly(spark, d))


@query("e2_time_profile", with_(X.S_USER, body="SELECT ts, avg(y) AS avg_y FROM hourly GROUP BY ts"), "avg_y")
def e2(spark, d):
    return S.time_profile(X.user_hourly(spark, d))


@query("e3_prior_month_template", with_(X.S_DAILY, body="""SELECT entity, CAST(extract(day FROM ts) AS INTEGER)
  AS day, CAST(extract(hour FROM ts) AS INTEGER) AS hour, avg(y) AS template FROM daily WHERE
  date_trunc('month', ts) = DATE '1998-06-01' GROUP BY 1, 2, 3"""), "template", 2)
def e3(spark, d):
    return S.prior_month_template(X.daily(spark, d), "1998-07-01")


@query("e4_growth_factor", with_(X.S_SUPPLIER, """m AS (SELECT entity, avg(y) FILTER (date_trunc('month', ts)
  = DATE '1995-02-01') AS same, avg(y) FILTER (date_trunc('month', ts) = DATE '1995-01-01') AS base FROM sdaily
  WHERE date_trunc('month', ts) IN (DATE '1995-01-01', DATE '1995-02-01') GROUP BY 1)""",
                                 body="""SELECT entity, CASE WHEN base > 0 THEN same / base ELSE 1.0 END
  AS growth FROM m"""), "growth")
def e4(spark, d):
    return S.growth_factor(X.supplier_daily(spark, d), "1996-02-01")


@query("e5_quartiles_by_hour", """SELECT CAST(extract(hour FROM ts) AS INTEGER) AS hour, count(value) AS n,
  quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3
  FROM events GROUP BY 1""", "q1 median q3")
def e5(spark, d):
    return S.quartiles_by(X.readings(spark, d), F.hour("ts"), "hour")


@query("e5_quartiles_by_weekday", """SELECT CAST(isodow(l_shipdate) - 1 AS INTEGER) AS weekday, count(*) AS n,
  quantile_cont(l_quantity, 0.25) AS q1, quantile_cont(l_quantity, 0.5) AS median,
  quantile_cont(l_quantity, 0.75) AS q3 FROM lineitem GROUP BY 1""", "q1 median q3")
def e5_weekday(spark, d):
    li = X.table(spark, d, "lineitem").select(F.col("l_shipdate").alias("ts"), F.col("l_quantity").alias("y"))
    return S.quartiles_by(li, F.weekday("ts"), "weekday")


@query("e6_histogram", """WITH lim AS (SELECT min(l_extendedprice) - 50000 AS lo, max(l_extendedprice) - 50000
  AS hi FROM lineitem), c AS (SELECT CAST(least(floor((l_extendedprice - 50000 - lo) / (hi - lo) * 100), 99)
  AS INTEGER) AS bin, count(*) AS n FROM lineitem, lim GROUP BY 1) SELECT CAST(b AS INTEGER) AS bin, lo + b * ((hi - lo)
  / 100) AS "left", lo + b * ((hi - lo) / 100) + (hi - lo) / 100 AS "right", coalesce(n, 0) AS n,
  lo + b * ((hi - lo) / 100) + (hi - lo) / 200 < 0 AS negative
  FROM range(100) r(b) JOIN lim ON true LEFT JOIN c ON c.bin = b""", "left right")
def e6(spark, d):
    li = X.table(spark, d, "lineitem").select((F.col("l_extendedprice") - 50000).alias("v"))
    return S.histogram(li, "v")


@query("e7_load_shapes", with_(X.S_USER, """means AS (SELECT entity, """ + ", ".join(
    f"coalesce(avg(y) FILTER (extract(hour FROM ts) = {h}), 0) AS m{h}" for h in range(24)) + ", " + ", ".join(
    f"coalesce(avg(y) FILTER (isodow(ts) - 1 = {w}), 0) AS w{w}" for w in range(7)) + """ FROM hourly
  GROUP BY entity), lev AS (SELECT *, (""" + " + ".join(f"m{h}" for h in range(24)) + ") / 24 AS hm, (" +
    " + ".join(f"w{w}" for w in range(7)) + ") / 7 AS dm FROM means)", body="SELECT entity, " + ", ".join(
    f"m{h} / CASE WHEN hm > 0 THEN hm ELSE 1 END AS h{h}" for h in range(24)) + ", " + ", ".join(
    f"w{w} / CASE WHEN dm > 0 THEN dm ELSE 1 END AS d{w}" for w in range(7)) + " FROM lev"),
       " ".join([f"h{h}" for h in range(24)] + [f"d{w}" for w in range(7)]))
def e7(spark, d):
    return S.load_shapes(X.user_hourly(spark, d))


@query("e8_most_common", """SELECT l_suppkey, min(l_quantity) AS mode FROM (SELECT l_suppkey, l_quantity,
  rank() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC) AS r FROM lineitem GROUP BY 1, 2)
  WHERE r = 1 GROUP BY 1""")
def e8(spark, d):
    return S.most_common(X.table(spark, d, "lineitem"), ["l_suppkey"], "l_quantity")


@query("e8_group_sizes", "SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1")
def e8_sizes(spark, d):
    return S.group_sizes(X.table(spark, d, "customer"), ["c_nationkey"])


@query("e8_distinct_counts", """SELECT 'l_suppkey' AS "column", count(DISTINCT l_suppkey) AS distinct_values
  FROM lineitem UNION ALL SELECT 'l_quantity', count(DISTINCT l_quantity) FROM lineitem""")
def e8_distinct(spark, d):
    return S.distinct_counts(X.table(spark, d, "lineitem"), ["l_suppkey", "l_quantity"])


@query("e9_first_values", with_(X.S_DAILY, body="""SELECT entity, arg_min(y, ts) AS y FROM daily
  GROUP BY entity"""), "y", 2)
def e9(spark, d):
    return S.first_values(X.daily(spark, d), ["y"])


@query("e9_static_scaler", """SELECT avg(v) AS latitude_mean, stddev_pop(v) AS latitude_std FROM (SELECT
  44 + (s_suppkey * 37 % 801) / 100.0 AS v FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem))""",
       "latitude_mean latitude_std")
def e9_scaler(spark, d):
    from ..functions.scaling import fit_global
    rich = X.supplier_daily(spark, d).join(X.stations(spark, d), "entity")
    return fit_global(S.first_values(rich, ["latitude"]), ["latitude"])


@query("e10_request_plan", with_(X.S_STATIONS, X.S_SUPPLIER, body="""SELECT latitude, longitude,
  CAST(CAST(min(ts) AS DATE) AS VARCHAR) AS start_date, CAST(CAST(max(ts) AS DATE) AS VARCHAR) AS end_date FROM sdaily JOIN stations USING (entity)
  GROUP BY 1, 2"""), "latitude longitude")
def e10(spark, d):
    plan = S.request_plan(X.supplier_daily(spark, d).join(X.stations(spark, d), "entity"))
    return plan.select("latitude", "longitude", F.col("start_date").cast("string").alias("start_date"),
                       F.col("end_date").cast("string").alias("end_date"))


@query("e11_wide_pivot", with_(X.S_GRID, body="SELECT time_idx, " + ", ".join(
    f"coalesce(max(CASE WHEN entity = '{e}' THEN y END), 0) AS {e}_y" for e in
    ("click", "error", "purchase", "signup", "view")) + " FROM grid GROUP BY 1"),
       "click_y error_y purchase_y signup_y view_y")
def e11(spark, d):
    from ..functions.encode import categories
    g = X.full(spark, d)
    return S.wide(g, categories(X.table(spark, d, "events"), "event_type")["event_type"], ["y"])


@query("e11_wide_arrays", with_(X.S_USER, body="""SELECT ts, count(*) AS n_cells, min(code) AS first_code,
  max(code) AS last_code, sum(code * coalesce(y, 0)) AS weighted FROM hourly JOIN (SELECT entity, row_number()
  OVER (ORDER BY entity) - 1 AS code FROM (SELECT DISTINCT entity FROM hourly)) USING (entity) GROUP BY ts"""),
       "weighted")
def e11_arrays(spark, d):
    rows, _ = S.wide_arrays(X.user_hourly(spark, d), ["y"], by="ts")
    return rows.select("ts", F.size("codes").cast("long").alias("n_cells"), F.get("codes", F.lit(0)).alias("first_code"),
                       F.element_at("codes", -1).alias("last_code"),
                       F.aggregate(F.zip_with("codes", "y", lambda c, y: c * y), F.lit(0.0),
                                   lambda a, v: a + v).alias("weighted"))


@query("e12_entity_summary", with_(X.S_SUPPLIER, body="""SELECT entity, count(y) AS rows, avg(y) AS mean_y,
  stddev_samp(y) AS std_y FROM sdaily GROUP BY 1"""), "mean_y std_y")
def e12(spark, d):
    return S.entity_summary(X.supplier_daily(spark, d))


@query("e13_length_stats", with_(X.S_USER, body="""SELECT count(*) AS entities, min(n) AS min_len, max(n) AS
  max_len, avg(n) AS mean_len, count(*) FILTER (n >= 64) AS long_enough FROM (SELECT count(*) AS n FROM hourly
  GROUP BY entity)"""), "mean_len")
def e13(spark, d):
    return S.length_stats(X.user_hourly(spark, d), 64)


@query("d5_group_values", with_(X.S_USER, body="""SELECT entity, ts, y, max(y) OVER w AS top, count(y) OVER w AS n
  FROM hourly WINDOW w AS (PARTITION BY entity)"""), "y top")
def d5(spark, d):
    return K.group_values(X.user_hourly(spark, d), ["entity"], top=F.max("y"), n=F.count("y"))


@query("f17_trajectory_quantiles", """WITH s AS (SELECT event_type AS entity, CAST(extract(hour FROM ts) AS
  INTEGER) AS step, value AS y FROM events) SELECT entity, step, count(y) AS n, quantile_cont(y, 0.1) AS p10,
  quantile_cont(y, 0.5) AS pred, quantile_cont(y, 0.9) AS p90 FROM s GROUP BY 1, 2""", "p10 pred p90")
def f17(spark, d):
    s = X.readings(spark, d).withColumn("step", F.hour("ts"))
    return exact_quantiles(s, ["entity", "step"], "y", {"p10": 0.1, "pred": 0.5, "p90": 0.9})


@query("f17_quantiles_of_all", """SELECT count(l_extendedprice) AS n, quantile_cont(l_extendedprice, 0.5) AS
  median, quantile_cont(l_extendedprice, 0.99) AS p99 FROM lineitem""", "median p99")
def f17_all(spark, d):
    return exact_quantiles(X.table(spark, d, "lineitem"), [], "l_extendedprice", {"median": 0.5, "p99": 0.99})


# --- sorts, unions, set operations -----------------------------------------------------

@query("u1_sorted_panel", with_(X.S_HOURLY, body="SELECT entity, ts, y FROM hourly ORDER BY entity, ts"), "y")
def u1(spark, d):
    return X.hourly(spark, d).orderBy("entity", "ts")


@query("u2_union_of_splits", with_(X.S_HOURLY, body="SELECT entity, ts, y FROM hourly"), "y")
def u2(spark, d):
    h = G.label_splits(X.hourly(spark, d), "2024-01-20", "2024-01-26")
    parts = [h.filter(F.col("data_subset") == s).drop("data_subset") for s in ("train", "val", "test")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_SETS = """a AS (SELECT DISTINCT user_id AS entity FROM events WHERE value > 150), b AS (SELECT DISTINCT user_id
  AS entity FROM events WHERE ts >= TIMESTAMP '2024-01-30')"""


@query("u3_key_sets", with_(_SETS, body="""SELECT 'both' AS kind, entity FROM (SELECT * FROM a INTERSECT SELECT *
  FROM b) UNION ALL SELECT 'only_a', entity FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL
  SELECT 'any', entity FROM (SELECT * FROM a UNION SELECT * FROM b)"""))
def u3(spark, d):
    e = X.table(spark, d, "events")
    a = e.filter("value > 150").select(F.col("user_id").alias("entity")).distinct()
    b = e.filter(F.col("ts") >= F.lit("2024-01-30").cast("timestamp_ntz")).select(
        F.col("user_id").alias("entity")).distinct()
    name = lambda df, k: df.select(F.lit(k).alias("kind"), "entity")
    return (name(a.intersect(b), "both").unionByName(name(a.exceptAll(b), "only_a"))
            .unionByName(name(a.unionByName(b).distinct(), "any")))


@query("u4_distinct_keys", "SELECT DISTINCT user_id, event_type FROM events")
def u4(spark, d):
    return X.table(spark, d, "events").select("user_id", "event_type").distinct()


@query("u5_head_and_tail", with_(X.S_USER, body="""SELECT entity, ts, y FROM (SELECT *, row_number() OVER
  (PARTITION BY entity ORDER BY ts) AS a, row_number() OVER (PARTITION BY entity ORDER BY ts DESC) AS b
  FROM hourly) WHERE a <= 3 OR b <= 3"""), "y")
def u5(spark, d):
    u = X.user_hourly(spark, d)
    return K.first_rows(u, 3, PANEL).unionByName(K.last_rows(u, 3, PANEL)).distinct()
