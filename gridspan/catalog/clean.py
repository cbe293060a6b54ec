"""Queries over sources and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as C
from ..operators import clean as K
from ..operators import grid as G
from ..operators import stats
from ..plans.lineage import new_path
from ..sources import payloads as J
from ..sources import prices as P
from ..sources import readings as R
from ..sources import sinks as W
from ..spec import PANEL, TOTAL_LABELS
from . import fixtures as X
from .registry import query, with_


def _landed(spark, d):
    """Event rows as landed sheet rows with report totals among them."""
    e = X.table(spark, d, "events")
    raw = e.select(F.col("event_type").alias("EIC"), F.to_date("ts").cast("string").alias("Date"),
                   F.when(F.col("event_id") % 10 != 0, F.hour("ts")).alias("Hour"),
                   F.col("value").alias("kWh"))
    totals = e.groupBy(F.to_date("ts").cast("string").alias("Date")).agg(F.sum("value").alias("kWh")).select(
        F.lit("Grand Total").alias("EIC"), "Date", F.lit(None).cast("int").alias("Hour"), "kWh")
    nameless = e.filter("event_id % 97 = 0").select(F.lit(None).cast("string").alias("EIC"),
                                                    F.lit("no date").alias("Date"),
                                                    F.lit(1).alias("Hour"), F.col("value").alias("kWh"))
    return raw.unionByName(totals).unionByName(nameless)


_S_LANDED = """SELECT event_type AS entity, date_trunc('day', ts) + (CASE WHEN event_id % 10 <> 0
  THEN extract(hour FROM ts) ELSE 0 END) * INTERVAL 1 HOUR AS ts, value AS y FROM events
  UNION ALL SELECT NULL, NULL, value FROM events WHERE event_id % 97 = 0"""


@query("a1_read_sheets", _S_LANDED, "y")
def a1(spark, d):
    path = new_path(spark, "sheets")
    head = X.table(spark, d, "events").filter("event_id % 1000 = 0").select(
        F.concat(F.lit("Report "), "event_id").alias("EIC"), *[F.lit(None).alias(c) for c in
                                                              ("Date", "Hour", "kWh")])
    _landed(spark, d).unionByName(head).write.option("header", True).csv(path)
    raw = R.read_sheets(spark, path, {"EIC": "entity", "Date": "date", "Hour": "hour", "kWh": "y"},
                        {"hour": "int", "y": "double"})
    return R.conform_readings(raw)


_SHEET = {"EIC": "entity", "Date": "date", "Hour": "hour", "kWh": "y"}


def _sheet_with_noise(spark, d):
    """Readings as a sheet in which some hours and values cannot be read, some lines repeat, and headers stand between."""
    e = X.table(spark, d, "events")
    hour = F.when(F.col("event_id") % 7 == 0, F.lit("7h")).otherwise(F.hour("ts").cast("string"))
    value = F.when(F.col("event_id") % 5 == 0, F.lit("n/a")).otherwise(F.col("event_id").cast("string"))
    lines = e.select(F.col("event_type").alias("EIC"), F.to_date("ts").cast("string").alias("Date"),
                     hour.alias("Hour"), value.alias("kWh"))
    path = new_path(spark, "noisy-sheets")
    lines.write.option("header", True).csv(path)
    return path


@query("a1_rejects", """SELECT 'good' AS kind, NULL AS reasons, NULL AS line, count(*) AS n, sum(event_id) AS load FROM events
  WHERE event_id % 5 <> 0 AND event_id % 7 <> 0 UNION ALL SELECT 'rejected', reasons, line, count(*), NULL FROM (SELECT
  array_to_string(list_filter([CASE WHEN event_id % 7 = 0 THEN 'hour is unreadable' END, CASE WHEN event_id % 5 = 0 THEN
  'y is unreadable' END], lambda x: x IS NOT NULL), ', ') AS reasons, '{"entity":"' || event_type || '","date":"' ||
  strftime(ts, '%Y-%m-%d') || '","hour":"' || CASE WHEN event_id % 7 = 0 THEN '7h' ELSE extract(hour FROM ts)::VARCHAR
  END || '","y":"' || CASE WHEN event_id % 5 = 0 THEN 'n/a' ELSE event_id::VARCHAR END || '"}' AS line FROM events
  WHERE event_id % 5 = 0 OR event_id % 7 = 0) GROUP BY ALL""", "load")
def a1_rejects(spark, d):
    """Both outputs of one read: the good rows, and every other line with its reasons and count."""
    path, types = _sheet_with_noise(spark, d), {"hour": "int", "y": "double"}
    good = R.read_sheets(spark, path, _SHEET, types).agg(
        F.lit("good").alias("kind"), F.lit(None).cast("string").alias("reasons"), F.lit(None).cast("string").alias("line"),
        F.count("*").alias("n"), F.sum("y").alias("load"))
    bad = R.rejected_lines(spark, path, _SHEET, types).select(
        F.lit("rejected").alias("kind"), "reasons", "line", "n", F.lit(None).cast("double").alias("load"))
    return good.unionByName(bad)


@query("a1_read_parts", """SELECT event_id, event_type AS entity, CASE WHEN event_id % 2 = 0 THEN
  value END AS y, CASE WHEN event_id % 2 = 1 THEN user_id ELSE -1 END AS user_id FROM events""", "y")
def a1_parts(spark, d):
    e, path = X.table(spark, d, "events"), new_path(spark, "parts")
    even = e.filter("event_id % 2 = 0").select("event_id", F.col("event_type").alias("entity"),
                                               F.col("value").alias("y"))
    odd = e.filter("event_id % 2 = 1").select("event_id", F.col("event_type").alias("entity"), "user_id")
    even.write.parquet(f"{path}/a")
    odd.write.parquet(f"{path}/b")
    return R.read_parts(spark, [f"{path}/a", f"{path}/b"]).select(
        "event_id", "entity", "y", F.coalesce("user_id", F.lit(-1)).alias("user_id"))


@query("a2_drop_total_rows", """SELECT event_type AS entity, value AS y FROM events UNION ALL
  SELECT NULL, value FROM events WHERE event_id % 97 = 0""", "y")
def a2(spark, d):
    return K.drop_labels(_landed(spark, d), "EIC", TOTAL_LABELS).select(
        F.col("EIC").alias("entity"), F.col("kWh").alias("y"))


@query("a3_read_panel", "SELECT l_suppkey, l_shipdate, l_quantity FROM lineitem "
                        "WHERE l_shipdate >= TIMESTAMP '2000-01-01'")
def a3(spark, d):
    spec = PANEL.with_(entity="l_suppkey", ts="l_shipdate", idx="l_shipdate")
    df = R.read_panel(spark, f"{d}/lineitem.parquet", spec,
                      ["l_suppkey", "l_shipdate", "l_quantity"], partitions=8)
    return df.filter(F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp_ntz"))


@query("a4_gold_layouts", with_(X.S_INDEXED, """gold AS (SELECT *, CASE WHEN ts < TIMESTAMP '2024-01-20' THEN 'train'
  WHEN ts < TIMESTAMP '2024-01-26' THEN 'val' ELSE 'test' END AS data_subset FROM indexed)""", body="""SELECT data_subset,
  count(*) AS text_rows, sum(y) AS text_load, count(*) AS hot_rows, CAST(count(*) FILTER (month(ts) IN (12, 1, 2)) AS BIGINT)
  AS winter_rows, CAST(count(*) FILTER (hour(ts) = 5) AS BIGINT) AS five_rows, sum(CASE WHEN isodow(ts) = 1 THEN y END)
  AS monday_load FROM gold GROUP BY 1"""), "text_load monday_load", 2)
def a4(spark, d):
    df = G.label_splits(X.indexed(spark, d), "2024-01-20", "2024-01-26")
    df = K.project(df, {"entity": "eic_code", "ts": "datetime", "y": "y", "time_idx": "time_idx",
                        "data_subset": "data_subset"})
    df = df.select("*", *[e.alias(n) for n, e in C.calendar_fields("datetime", as_text=True).items()])
    paths = W.write_gold(df, new_path(spark, "gold"))
    text, hot = spark.read.parquet(paths["text"]), spark.read.parquet(paths["one_hot"])
    return (text.groupBy("data_subset").agg(F.count("*").alias("text_rows"), F.sum("y").alias("text_load"))
            .join(hot.groupBy("data_subset").agg(
                F.count("*").alias("hot_rows"), F.sum("season_1").alias("winter_rows"), F.sum("Hour_5").alias("five_rows"),
                F.sum(F.when(F.col("day_of_week_0") == 1, F.col("y"))).alias("monday_load")), "data_subset"))


@query("a5_silver_stage", with_(X.S_INDEXED, body="SELECT entity, ts, y, time_idx FROM indexed "
                                                  "WHERE time_idx < 240"), "y")
def a5(spark, d):
    silver = W.write_stage(X.indexed(spark, d), new_path(spark, "silver"))
    return silver.filter("time_idx < 240")


@query("a6_results_csv", with_(X.S_HOURLY, body="""SELECT entity, count(y) AS rows, avg(y) AS mean_y,
  stddev_samp(y) AS std_y FROM hourly GROUP BY entity"""), "mean_y std_y")
def a6(spark, d):
    path = W.write_csv(stats.entity_summary(X.hourly(spark, d)), new_path(spark, "csv"))
    return spark.read.schema("entity string, rows long, mean_y double, std_y double").option(
        "header", True).csv(path)


@query("a7_prediction_sink", with_(X.s_forecasts(), body="""SELECT entity, ts, pred,
  CASE WHEN ts < TIMESTAMP '2024-01-20' THEN 'val' ELSE 'test' END AS split FROM forecasts"""), "pred")
def a7(spark, d):
    f = X.forecasts(spark, d).select("entity", "ts", "pred", F.when(
        F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"), "val").otherwise("test").alias("split"))
    return spark.read.parquet(W.write_predictions(f, new_path(spark, "preds"), "split"))


def _payload(spark, d):
    """Per event type and day: parallel arrays of unequal length as JSON."""
    h = X.hourly(spark, d)
    rows = h.groupBy("entity", F.to_date("ts").alias("day")).agg(
        F.sort_array(F.collect_list(F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("t"),
                                             F.round("y", 2).alias("v")))).alias("r"))
    n = F.size("r")
    return rows.select("entity", F.to_json(F.struct(F.struct(
        F.col("r.t").alias("time"), F.slice(F.col("r.v"), F.lit(1), n - 1).alias("temperature_2m"),
        F.col("r.v").alias("rain")).alias("hourly"))).alias("payload"))


@query("a8_hourly_payload", with_(X.S_HOURLY, """numbered AS (SELECT entity, ts, round(y, 2) AS v,
  row_number() OVER w AS i, count(*) OVER (PARTITION BY entity, date_trunc('day', ts)) AS n FROM hourly
  WINDOW w AS (PARTITION BY entity, date_trunc('day', ts) ORDER BY ts))""", body="""SELECT entity, ts,
  CASE WHEN i < n THEN v END AS temperature_2m, v AS rain, CAST(NULL AS DOUBLE) AS snowfall
  FROM numbered"""), "temperature_2m rain snowfall", 1)
def a8(spark, d):
    return J.hourly_rows(_payload(spark, d), "payload", ["temperature_2m", "rain", "snowfall"])


def _alarms(spark, d):
    """Error events as alarms of their user's region; payloads without errors have none."""
    e = X.table(spark, d, "events")
    text = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    begin = F.date_trunc("second", "ts")
    length = F.make_dt_interval(mins=(F.col("event_id") % 200).cast("int"))
    one = F.when(F.col("event_type") == "error", F.struct(
        F.col("user_id").cast("string").alias("regionId"), text(begin).alias("startDate"),
        text(begin + length).alias("endDate"), F.lit("AIR").alias("alertType"),
        (F.col("event_id") % 2 == 0).alias("isContinue")))
    # A payload covers a run of 1,000 event numbers, which bounds its list.
    run = F.floor(F.col("event_id") / 1000)
    return e.groupBy("user_id", run.alias("run")).agg(F.collect_list(one).alias("alarms")).select(F.to_json(F.array(
        F.struct(F.col("user_id").cast("string").alias("regionId"),
                 F.concat(F.lit("R"), F.col("user_id")).alias("regionName"),
                 "alarms"))).alias("payload"))


S_ALARMS = """alarm_rows AS (SELECT CAST(u.user_id AS VARCHAR) AS region_id, 'R' || u.user_id AS
  region_name, date_trunc('second', e.ts) AS start, date_trunc('second', e.ts) + (event_id % 200)
  * INTERVAL 1 MINUTE AS "end", CASE WHEN event_id IS NOT NULL THEN 'AIR' END AS alert_type,
  coalesce(event_id % 2 = 0, false) AS is_continue FROM (SELECT DISTINCT user_id, event_id // 1000 AS run FROM events) u
  LEFT JOIN events e ON e.user_id = u.user_id AND event_id // 1000 = run AND event_type = 'error')"""


@query("a9_alarm_payload", with_(S_ALARMS, body="SELECT * FROM alarm_rows"))
def a9(spark, d):
    return J.alarm_rows(_alarms(spark, d), "payload").withColumn(
        "is_continue", F.coalesce("is_continue", F.lit(False)))


def _dictionary(spark, d):
    """Nations as one JSON dictionary."""
    n = X.table(spark, d, "nation")
    return n.agg(F.sort_array(F.collect_list(F.struct(
        F.col("n_nationkey").cast("string").alias("regionId"),
        F.concat("n_name", F.lit(" область ")).alias("regionName")))).alias("states")
    ).select(F.to_json(F.struct("states")).alias("payload"))


@query("a10_name_dictionary", """SELECT c.c_custkey AS entity, CASE WHEN c_custkey % 10 = 0 THEN 'capital'
  ELSE n_name END AS region_name, CASE WHEN c_custkey % 10 = 0 THEN '7' ELSE CAST(n_nationkey AS VARCHAR)
  END AS region_id FROM customer c JOIN nation ON c_nationkey = n_nationkey""")
def a10(spark, d):
    ids = J.name_ids(_dictionary(spark, d), "payload", special={"capital": "NATION_7"})
    c = X.table(spark, d, "customer").join(X.table(spark, d, "nation"),
                                           F.col("c_nationkey") == F.col("n_nationkey"))
    named = c.select(F.col("c_custkey").alias("entity"), F.when(F.col("c_custkey") % 10 == 0, "capital")
                     .otherwise(F.col("n_name")).alias("region_name"))
    return J.attach_ids(named, ids)


@query("a13_profile", """SELECT 'l_quantity' AS "column", count(*) AS rows, 11 * count(*) AS elements,
  count(*) - count(l_quantity) AS nulls, count(DISTINCT l_quantity) AS distinct_values FROM lineitem
  UNION ALL SELECT 'l_suppkey', count(*), 11 * count(*), count(*) - count(l_suppkey),
  count(DISTINCT l_suppkey) FROM lineitem""")
def a13(spark, d):
    df = stats.profile(X.table(spark, d, "lineitem"), ["l_quantity", "l_suppkey"], exact=True)
    return df.drop("lo", "hi")


@query("a13_flat_prices", with_(X.S_PRICES, body="SELECT ts, dam_price FROM prices"), "dam_price")
def a13_flat(spark, d):
    p = X.prices(spark, d)
    rows = p.select(F.year("ts").cast("string").alias("Year"), F.month("ts").alias("Month"),
                    F.dayofmonth("ts").alias("Day"), F.hour("ts").alias("Hour"), "dam_price")
    total = p.agg(F.sum("dam_price").alias("dam_price")).select(
        F.lit("Grand Total").alias("Year"), *[F.lit(None).cast("int").alias(c) for c in
                                              ("Month", "Day", "Hour")], "dam_price")
    return P.flat_prices(rows.unionByName(total), "Year", "Month", "Day", "Hour", "dam_price")


# --- cleaning -----------------------------------------------------------------------------

@query("b1_project_rename", "SELECT event_type AS eic_code, ts AS datetime, value AS kwh FROM events",
       "kwh")
def b1(spark, d):
    return K.project(X.table(spark, d, "events"), {"event_type": "eic_code", "ts": "datetime",
                                                   "value": "kwh"})


@query("b2_present_columns", "SELECT c_custkey, c_acctbal FROM customer", "c_acctbal")
def b2(spark, d):
    c = X.table(spark, d, "customer")
    import warnings
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        return c.select(*K.present(c, ["c_custkey", "c_phone", "c_acctbal"]))


@query("b3_drop_prefix_safe_names", """SELECT l_orderkey, l_linenumber, l_shipdate AS "ship_date"
  FROM lineitem""")
def b3(spark, d):
    li = X.table(spark, d, "lineitem").withColumnRenamed("l_shipdate", "ship.date")
    return K.safe_names(K.drop_by_prefix(li, "l_p", "l_s", "l_q", "l_e", "l_d", "l_t", "l_r")
                        ).select("l_orderkey", "l_linenumber", "ship_date")


@query("b4_timestamp_assembly", """SELECT event_id, CASE WHEN event_id % 13 <> 0 THEN
  date_trunc('hour', ts) END AS from_parts, date_trunc('day', ts) + (CASE WHEN event_id % 10 <> 0 THEN
  extract(hour FROM ts) ELSE 0 END) * INTERVAL 1 HOUR AS from_date FROM events""")
def b4(spark, d):
    e = X.table(spark, d, "events")
    month = F.when(F.col("event_id") % 13 == 0, 13).otherwise(F.month("ts"))
    return e.select("event_id", C.from_parts(F.year("ts"), month, F.dayofmonth("ts"), F.hour("ts"))
                    .alias("from_parts"),
                    C.from_date_and_hour(F.to_date("ts"), F.when(F.col("event_id") % 10 != 0, F.hour("ts")))
                    .alias("from_date"))


def _rules(spark):
    return K.rules_frame(spark, {"click": "2024-01-05", "view": "2024-01-20"}, {"click": 30.0},
                         {"error": 2.31163})


_S_RULES = """SELECT entity, ts, CASE WHEN entity = 'click' THEN least(y, 30.0) ELSE y END AS y,
  CASE WHEN entity = 'error' THEN 2.31163 ELSE 1.0 END AS dist_price FROM hourly
  WHERE NOT (entity = 'click' AND ts < TIMESTAMP '2024-01-05')
  AND NOT (entity = 'view' AND ts < TIMESTAMP '2024-01-20')"""


@query("b5_drop_before_rules", with_(X.S_HOURLY, body="SELECT entity, ts FROM (" + _S_RULES + ")"))
def b5(spark, d):
    return K.apply_rules(X.hourly(spark, d), _rules(spark)).select("entity", "ts")


@query("b6_cap_rules", with_(X.S_HOURLY, body="SELECT entity, ts, y FROM (" + _S_RULES + ")"), "y")
def b6(spark, d):
    return K.apply_rules(X.hourly(spark, d), _rules(spark))


@query("b7_constant_override", with_(X.S_HOURLY, body=_S_RULES), "y dist_price")
def b7(spark, d):
    return K.apply_rules(X.hourly(spark, d).withColumn("dist_price", F.lit(1.0)), _rules(spark),
                         override_column="dist_price")


@query("b8_patch_coordinates", with_(X.S_STATIONS, body="""SELECT entity, CASE WHEN entity % 9 < 2
  THEN (CASE WHEN entity % 2 = 0 THEN 48.5 END) ELSE latitude END AS latitude, longitude
  FROM stations"""), "latitude longitude")
def b8(spark, d):
    s = X.stations(spark, d).select("entity", F.when(F.col("entity") % 9 == 0, 0.0).when(
        F.col("entity") % 9 != 1, F.col("latitude")).alias("latitude"), "longitude")
    patch = X.stations(spark, d).filter("entity % 2 = 0").select(
        "entity", F.lit(48.5).alias("latitude"), F.lit(22.0).alias("longitude"))
    return K.patch_missing(s, patch, "entity", ["latitude", "longitude"])


@query("b9_fill_capacity", with_(X.S_USER, body="""SELECT entity, ts, y, CASE WHEN entity % 3 = 0
  THEN max(y) OVER (PARTITION BY entity) ELSE 100.0 END AS max_power, CASE WHEN entity % 3 = 0 THEN 'No'
  ELSE 'Yes' END AS max_power_present FROM hourly"""), "y max_power")
def b9(spark, d):
    u = X.user_hourly(spark, d).withColumn("max_power", F.when(F.col("entity") % 3 != 0, F.lit(100.0)))
    return K.fill_by_group_max(u, "max_power", flag="max_power_present")


@query("b10_coverage_filter", with_(X.S_USER, body="""SELECT * EXCLUDE (time_idx) FROM indexed WHERE
  entity IN (SELECT entity FROM hourly GROUP BY 1 HAVING max(ts) >= (SELECT max(ts) FROM hourly)
  - INTERVAL 12 HOUR AND count(*) >= 60)"""), "y")
def b10(spark, d):
    u = X.user_hourly(spark, d)
    reach = K.covered_entities(u, tail_days=1, min_rows=60)
    late = u.groupBy("entity").agg(F.max("ts").alias("m")).filter(
        F.col("m") >= u.agg(F.max("ts").alias("e")).scalar() - F.expr("interval 12 hours"))
    return u.join(reach.join(late, "entity", "left_semi"), "entity", "left_semi")


@query("b10_keep_covered", with_(X.S_SUPPLIER, body="""SELECT * FROM sdaily WHERE entity IN (SELECT
  entity FROM sdaily GROUP BY 1 HAVING max(ts) >= (SELECT max(ts) FROM sdaily) - INTERVAL 7 DAY
  AND count(*) >= 90)"""), "y")
def b10_keep(spark, d):
    return K.keep_covered(X.supplier_daily(spark, d), tail_days=7, min_rows=90)


@query("b11_in_all_splits", with_(X.S_SUPPLIER, """lab AS (SELECT *, CASE WHEN ts < TIMESTAMP
  '2001-09-01' THEN 'train' WHEN ts < TIMESTAMP '2001-10-25' THEN 'val' ELSE 'test' END AS data_subset
  FROM sdaily)""", body="""SELECT * FROM lab WHERE entity IN (SELECT entity FROM lab GROUP BY 1
  HAVING count(DISTINCT data_subset) = 3)"""), "y")
def b11(spark, d):
    lab = G.label_splits(X.supplier_daily(spark, d), "2001-09-01", "2001-10-25")
    return K.keep_in_all_splits(lab, ["train", "val", "test"])


@query("b12_over_capacity", with_(X.S_USER, body="""SELECT entity, ts, y, 60.0 AS max_power FROM hourly
  WHERE y > 75.0 AND y - 60.0 > 20"""), "y")
def b12(spark, d):
    u = X.user_hourly(spark, d).withColumn("max_power", F.lit(60.0))
    return K.over_capacity(u, "max_power")


@query("b12_offenders", with_(X.S_USER, body="""SELECT DISTINCT entity FROM hourly
  WHERE y > 75.0 AND y - 60.0 > 20"""))
def b12_distinct(spark, d):
    return b12(spark, d).select("entity").distinct()


@query("b14_range_filter", """SELECT event_type AS entity, ts, value AS y FROM events WHERE event_type
  IN ('click', 'view') AND ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-08 12:00:00'""", "y")
def b14(spark, d):
    e = X.readings(spark, d).select("entity", "ts", "y")
    return K.between(e, "2024-01-05", "2024-01-08 12:00:00", ["click", "view"])


@query("b15_unknown_target", with_(X.S_GRID, body="SELECT entity, ts, time_idx FROM grid WHERE y IS NULL"))
def b15(spark, d):
    return K.to_forecast(X.full(spark, d)).drop("y")


@query("b16_clip", with_(X.S_USER, body="""SELECT entity, ts, greatest(0.0, least(y - 20, 5.0)) AS a,
  greatest(0.0, y - 20) AS b FROM hourly"""), "a b")
def b16(spark, d):
    u = X.user_hourly(spark, d)
    return u.select("entity", "ts", K.clip(F.col("y") - 20, F.lit(5.0)).alias("a"),
                    K.clip(F.col("y") - 20).alias("b"))


@query("b17_excluded_rows", with_(X.S_GRID, """lagged AS (SELECT y, lag(y, 48) OVER (PARTITION BY entity
  ORDER BY ts) AS lag_48 FROM grid)""", body="""SELECT count(*) AS rows, count(*) FILTER (y IS NOT NULL AND
  lag_48 IS NOT NULL) AS kept, count(*) FILTER (y IS NULL OR lag_48 IS NULL) AS excluded FROM lagged"""))
def b17(spark, d):
    from ..operators.features import lag_columns
    return K.count_excluded(lag_columns(X.full(spark, d), [48], size=336), ["y", "lag_48"])


@query("b17_required_rows", with_(X.S_GRID, body="SELECT entity, ts, time_idx, y FROM grid WHERE y IS NOT NULL"),
       "y")
def b17_rows(spark, d):
    return K.require_values(X.full(spark, d), ["y"])


@query("b18_last_rows", with_(X.S_USER, body="""SELECT entity, ts, y FROM (SELECT *, row_number() OVER
  (PARTITION BY entity ORDER BY ts DESC) AS rn FROM hourly) WHERE rn <= 24"""), "y")
def b18(spark, d):
    return K.last_rows(X.user_hourly(spark, d), 24)


@query("b19_narrowing_profile", """SELECT 'l_orderkey' AS "column", CAST(min(l_orderkey) AS DOUBLE) AS lo,
  CAST(max(l_orderkey) AS DOUBLE) AS hi, 0 AS decimals, CASE WHEN max(l_orderkey) <= 127 THEN 'tinyint'
  WHEN max(l_orderkey) <= 32767 THEN 'smallint' ELSE 'int' END AS stored_as, 1 AS scale FROM lineitem
  UNION ALL SELECT 'l_linenumber', min(l_linenumber), max(l_linenumber), 0, 'tinyint', 1 FROM lineitem
  UNION ALL SELECT 'l_quantity', min(l_quantity), max(l_quantity), 0, 'tinyint', 1 FROM lineitem
  UNION ALL SELECT 'l_discount', min(l_discount), max(l_discount), 2, 'tinyint', 100 FROM lineitem
  UNION ALL SELECT 'l_extendedprice', min(l_extendedprice), max(l_extendedprice), 2, 'float', 1
  FROM lineitem""", "lo hi")
def b19(spark, d):
    li = X.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount",
                                              "l_extendedprice")
    return K.narrowing_profile(li)


@query("b19_narrow_and_widen", """SELECT l_orderkey, l_linenumber, l_discount FROM lineitem""",
       "l_discount")
def b19_round_trip(spark, d):
    li = X.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_discount")
    w = K.widen(K.narrow(li))
    return w.select(F.col("l_orderkey").cast("long").alias("l_orderkey"),
                    F.col("l_linenumber").cast("int").alias("l_linenumber"), "l_discount")


@query("b20_sample_entities")
def b20(spark, d):
    return K.sample_entities(X.user_hourly(spark, d), 40)


@query("b21_required_features", with_(X.S_HOURLY, body="SELECT entity, y FROM hourly"), "y")
def b21(spark, d):
    return K.require_features(X.hourly(spark, d), ["entity", "y"]).select("entity", "y")


@query("b22_align_columns", "SELECT event_id, value AS y, 0 AS oblast_x, user_id FROM events", "y")
def b22(spark, d):
    e = X.readings(spark, d)
    return K.align(e, ["y", "oblast_x", "user_id"], keep=["event_id"])
