"""Queries over lag, rolling, window and encoding features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as C
from ..functions import encode as N
from ..functions import scaling as Z
from ..operators import evaluate as V
from ..operators import features as L
from ..spec import LAG_HOURS, PANEL, ROLL_WINDOWS
from . import fixtures as X
from .registry import query, with_

SLAB = 336


def _y(spark, d):
    return X.full(spark, d)


_LAGS = ", ".join(f"lag(y, {k}) OVER w AS lag_{k}h" for k in LAG_HOURS)
_LAG_NAMES = " ".join(f"lag_{k}h" for k in LAG_HOURS)


@query("d1_lag_features", with_(X.S_GRID, body=f"""SELECT entity, ts, {_LAGS} FROM grid
  WINDOW w AS (PARTITION BY entity ORDER BY ts)"""), _LAG_NAMES)
def d1(spark, d):
    return L.lag_features(_y(spark, d), windows=(), diffs=(), size=SLAB).drop("y", "time_idx")


def _roll(fn: str, name: str) -> str:
    return ", ".join(
        f"CASE WHEN count(y) OVER w{n} >= {max(1, n // 4)} THEN {fn}(y) OVER w{n} END AS roll_{name}_{n}h"
        for n in ROLL_WINDOWS)


_FRAMES = ", ".join(f"w{n} AS (PARTITION BY entity ORDER BY ts ROWS BETWEEN {48 + n - 1} PRECEDING AND 48 "
                    "PRECEDING)" for n in ROLL_WINDOWS)


@query("d2_rolling_mean", with_(X.S_GRID, body=f"SELECT entity, ts, {_roll('avg', 'mean')} FROM grid "
                                f"WINDOW {_FRAMES}"), "roll_mean_24h roll_mean_48h roll_mean_168h")
def d2(spark, d):
    f = L.lag_features(_y(spark, d), lags=(), diffs=(), size=SLAB)
    return f.select("entity", "ts", *[f"roll_mean_{n}h" for n in ROLL_WINDOWS])


@query("d3_rolling_std", with_(X.S_GRID, body=f"SELECT entity, ts, {_roll('stddev_samp', 'std')} FROM grid "
                               f"WINDOW {_FRAMES}"), "roll_std_24h roll_std_48h roll_std_168h")
def d3(spark, d):
    f = L.lag_features(_y(spark, d), lags=(), diffs=(), size=SLAB)
    return f.select("entity", "ts", *[f"roll_std_{n}h" for n in ROLL_WINDOWS])


@query("d4_seasonal_diffs", with_(X.S_GRID, body="""SELECT entity, ts, lag(y, 48) OVER w - lag(y, 72) OVER w AS
  diff_24h, lag(y, 48) OVER w - lag(y, 96) OVER w AS diff_48h, lag(y, 48) OVER w - lag(y, 216) OVER w AS diff_168h
  FROM grid WINDOW w AS (PARTITION BY entity ORDER BY ts)"""), "diff_24h diff_48h diff_168h")
def d4(spark, d):
    f = L.lag_features(_y(spark, d), lags=(), windows=(), diffs=(24, 48, 168), size=SLAB)
    return f.select("entity", "ts", "diff_24h", "diff_48h", "diff_168h")


@query("d1_d4_feature_set", with_(X.S_GRID, body=f"""SELECT entity, ts, y, time_idx, {_LAGS},
  {_roll('avg', 'mean')}, {_roll('stddev_samp', 'std')}, lag(y, 48) OVER w - lag(y, 96) OVER w AS diff_48h,
  lag(y, 48) OVER w - lag(y, 216) OVER w AS diff_168h FROM grid
  WINDOW w AS (PARTITION BY entity ORDER BY ts), {_FRAMES}"""),
       "y " + _LAG_NAMES + " " + " ".join(f"roll_{s}_{n}h" for s in ("mean", "std") for n in ROLL_WINDOWS)
       + " diff_48h diff_168h")
def d_all(spark, d):
    return L.lag_features(_y(spark, d), size=SLAB)


_WIN = """base AS (SELECT entity, min(time_idx) AS a, max(time_idx) AS b FROM grid GROUP BY 1),
  starts AS (SELECT entity, a + unnest(generate_series(0, b - a + 1 - {span} - {hold}, {stride})) AS start_idx
    FROM base WHERE b - a + 1 - {span} - {hold} >= 0)"""
_JOINED = """w AS (SELECT s.entity, start_idx, start_idx + 48 AS origin_idx, time_idx - start_idx AS k, y, ts
  FROM starts s JOIN grid g ON g.entity = s.entity AND time_idx BETWEEN start_idx AND start_idx + 71)"""


@query("d6_window_samples", with_(X.S_GRID, _WIN.format(span=72, hold=0, stride=24), _JOINED, body="""SELECT
  entity, start_idx, origin_idx, count(y) FILTER (k < 48) AS known_context, count(y) FILTER (k >= 48) AS
  known_target, sum(y * (k + 1)) FILTER (k < 48) AS context_sum, sum(y * (k - 47)) FILTER (k >= 48) AS target_sum
  FROM w GROUP BY 1, 2, 3 HAVING count(*) = 72"""), "context_sum target_sum")
def d6(spark, d):
    g = _y(spark, d)
    w = L.window_samples(g, L.window_starts(g, 48, 24, 24), 48, 24)

    def weighted(c):
        return F.aggregate(F.transform(c, lambda v, i: F.coalesce(v, F.lit(0.0)) * (i + 1)), F.lit(0.0),
                           lambda a, v: a + v)

    def known(c):
        return F.size(F.filter(c, lambda v: v.isNotNull())).cast("long")
    return w.select("entity", "start_idx", "origin_idx", known("context").alias("known_context"),
                    known("target").alias("known_target"), weighted("context").alias("context_sum"),
                    weighted("target").alias("target_sum"))


@query("d7_patched_windows", with_(X.S_GRID, _WIN.format(span=72, hold=0, stride=72), _JOINED, body="""SELECT
  entity, start_idx, k // 24 AS patch, coalesce(sum(y), 0) AS total, 32 AS width, 24 AS observed,
  k // 24 = 2 AS predicted FROM w GROUP BY 1, 2, 3"""), "total")
def d7(spark, d):
    g = _y(spark, d)
    w = L.window_samples(g, L.window_starts(g, 48, 24, 72), 48, 24)
    observed, predicted = L.patch_masks(48, 24, 24, 32)
    p = w.select("entity", "start_idx", F.posexplode(L.patches(F.concat("context", "target"), 24, 32)).alias(
        "patch", "v"), observed.alias("o"), predicted.alias("p"))
    total = F.aggregate("v", F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0)))
    return p.select("entity", "start_idx", F.col("patch").cast("long").alias("patch"), total.alias("total"),
                    F.size("v").alias("width"), F.size(F.filter("o", lambda x: x)).alias("observed"),
                    F.get("p", F.col("patch")).alias("predicted"))


@query("d8_outage_flag", with_(X.S_GRID, """m AS (SELECT *, median(y) OVER s AS median_y, count(y) OVER s AS
  count_y FROM grid WINDOW s AS (PARTITION BY entity, isodow(ts), extract(hour FROM ts)))""",
                               body="""SELECT entity, ts, y, time_idx, median_y, count_y, CASE WHEN count_y >= 4
  AND y < 0.25 * median_y THEN 1 ELSE 0 END AS outage FROM m"""), "y median_y")
def d8(spark, d):
    return L.outage_flag(_y(spark, d), minimum=4, keep_stats=True)


@query("b13_low_outliers", with_(X.S_GRID, """m AS (SELECT *, median(y) OVER s AS median_y, count(y) OVER s AS
  count_y FROM grid WINDOW s AS (PARTITION BY entity, isodow(ts), extract(hour FROM ts)))""",
                                 body="""SELECT entity, ts, y, median_y, count_y FROM m WHERE count_y >= 4
  AND y < 0.25 * median_y"""), "y median_y")
def b13(spark, d):
    return L.outage_flag(_y(spark, d), minimum=4, keep_stats=True).filter("outage = 1").select(
        "entity", "ts", "y", "median_y", "count_y")


@query("d9_random_windows")
def d9(spark, d):
    g = _y(spark, d)
    starts = L.sample_starts(L.window_starts(g, 168, 48, 1), 5)
    return L.window_samples(g, starts, 168, 48)


_DEC = """tr AS (SELECT *, CASE WHEN count(y) OVER c = 25 THEN (sum(y) OVER c - (lag(y, 12) OVER o + lead(y, 12)
  OVER o) / 2) / 24 END AS trend, (time_idx - min(time_idx) OVER (PARTITION BY entity)) % 24 AS phase FROM grid
  WINDOW o AS (PARTITION BY entity ORDER BY ts), c AS (PARTITION BY entity ORDER BY ts ROWS BETWEEN 12 PRECEDING
  AND 12 FOLLOWING)), pm AS (SELECT entity, phase, avg(y - trend) AS m FROM tr GROUP BY 1, 2),
  pat AS (SELECT entity, phase, m - avg(m) OVER (PARTITION BY entity) AS seasonal FROM pm),
  dec AS (SELECT tr.*, seasonal, y - trend - seasonal AS resid FROM tr JOIN pat USING (entity, phase))"""
# A gap-free panel: unknown hours count as 0 load.
_DENSE = X.S_GRID.replace(" grid AS (", " grid0 AS (") + """, grid AS (SELECT entity, ts, coalesce(y, 0.0) AS y,
  time_idx FROM grid0)"""


def dense(spark, d):
    return _y(spark, d).withColumn("y", F.coalesce("y", F.lit(0.0)))


@query("d10_decompose", with_(_DENSE, _DEC, body="""SELECT entity, ts, y, time_idx, CAST(phase AS INTEGER) AS
  phase, trend, seasonal, resid FROM dec"""), "y trend seasonal resid")
def d10(spark, d):
    return L.decompose(dense(spark, d), size=SLAB)


_LINE = """tail AS (SELECT entity, time_idx, trend, trend - lag(trend) OVER (PARTITION BY entity ORDER BY time_idx)
  AS d FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY time_idx DESC) AS rn FROM dec WHERE trend
  IS NOT NULL) WHERE rn <= 336), line AS (SELECT entity, arg_max(trend, time_idx) AS level, median(d) AS s FROM tail
  GROUP BY 1), slopes AS (SELECT entity, level, greatest(-0.2 * abs(level) / 72, least(s, 0.2 * abs(level) / 72))
  AS slope FROM line)"""


@query("d11_trend_line", with_(_DENSE, _DEC, _LINE, body="SELECT * FROM slopes"), "level slope", 5)
def d11(spark, d):
    return L.trend_line(L.decompose(dense(spark, d), size=SLAB), 72)


@query("d12_recompose", with_(_DENSE, _DEC, _LINE, """facts AS (SELECT entity, max(time_idx) AS b, max(ts) AS t,
  max(y) AS top, avg(coalesce(y, 0)) AS mean, max(time_idx) - min(time_idx) + 1 AS n FROM grid GROUP BY 1), fut AS
  (SELECT f.*, coalesce(level, mean, 0) AS level, coalesce(slope, 0) AS slope, unnest(generate_series(1, 72)) AS step
  FROM facts f LEFT JOIN slopes USING (entity))""", body="""SELECT f.entity,
  b + step AS time_idx, t + step * INTERVAL 1 HOUR AS ts, CAST(step AS INTEGER) AS step, greatest(0.0, least(level
  + slope * step + coalesce(seasonal, 0), CASE WHEN top > 0 THEN 5 * top ELSE 1e300 END)) AS pred FROM fut f LEFT JOIN pat p
  ON p.entity = f.entity AND p.phase = (n + step - 1) % 24"""), "pred")
def d12(spark, d):
    return L.recompose(L.decompose(dense(spark, d), size=SLAB), 72)


@query("d13_normalised_windows", with_(_DENSE, _WIN.format(span=72, hold=0, stride=48), _JOINED, """st AS (SELECT
  entity, start_idx, avg(y) FILTER (k < 48) AS norm_mean, greatest(stddev_pop(y) FILTER (k < 48), 1e-5) AS norm_std
  FROM w GROUP BY 1, 2)""", body="""SELECT w.entity, w.start_idx, norm_mean, norm_std, max((y - norm_mean)
  / norm_std) FILTER (k >= 48) AS top_target, max(y) FILTER (k >= 48) AS top_back FROM w JOIN st USING (entity,
  start_idx) GROUP BY ALL"""), "norm_mean norm_std top_target top_back")
def d13(spark, d):
    g = dense(spark, d)
    w = L.normalise_windows(L.window_samples(g, L.window_starts(g, 48, 24, 48), 48, 24))
    return w.select("entity", "start_idx", "norm_mean", "norm_std", F.array_max("target").alias("top_target"),
                    F.array_max(L.denormalise("target")).alias("top_back"))


@query("d17_covariate_roles", with_(_DENSE, X.S_PRICES, _WIN.format(span=72, hold=0, stride=72), """w AS (SELECT
  s.entity, start_idx, time_idx - start_idx AS k, y, g.ts, dam_price FROM starts s JOIN grid g ON g.entity = s.entity
  AND time_idx BETWEEN start_idx AND start_idx + 71 JOIN prices p ON p.ts = g.ts)""", body="""SELECT entity,
  start_idx, start_idx + 48 AS origin_idx, count(*) FILTER (k < 48) AS past_n, count(*) AS all_n,
  sum(dam_price) AS all_sum, sum(dam_price) FILTER (k < 48) AS past_sum, 'S_' || entity AS station_type FROM w
  GROUP BY 1, 2"""), "all_sum past_sum", 3)
def d17(spark, d):
    g = dense(spark, d).join(X.prices(spark, d).select("ts", "dam_price", F.col("dam_price").alias("obs")), "ts")
    g = g.withColumn("station_type", F.concat(F.lit("S_"), "entity"))
    spec = PANEL.with_(known_future=("dam_price",), past_only=("obs",), static=("station_type",))
    w = L.window_samples(g, L.window_starts(g, 48, 24, 72), 48, 24, spec)
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, v: a + v)
    return w.select("entity", "start_idx", "origin_idx", F.size("past_obs").cast("long").alias("past_n"),
                    F.size("all_dam_price").cast("long").alias("all_n"), total("all_dam_price").alias("all_sum"),
                    total("past_obs").alias("past_sum"), "station_type")


@query("d18_holdout_windows", with_(X.S_GRID, _WIN.format(span=72, hold=100, stride=48), body="""SELECT entity,
  start_idx FROM starts"""))
def d18(spark, d):
    return L.window_starts(_y(spark, d), 48, 24, 48, holdout=100)


@query("d18_tail_window", with_(X.S_GRID, body="""SELECT entity, max(time_idx) - 71 AS start_idx FROM grid
  GROUP BY 1 HAVING count(*) >= 72"""))
def d18_tail(spark, d):
    return L.window_starts(_y(spark, d), 48, 24, tail_only=True)


@query("d19_position_covariates", with_(X.S_GRID, body="""SELECT entity, ts, y, time_idx, avg(y) OVER p AS y_center,
  stddev_samp(y) OVER p AS y_scale, time_idx - min(time_idx) OVER p AS rel_idx, least(time_idx - min(time_idx)
  OVER p, 168) AS history FROM grid WINDOW p AS (PARTITION BY entity)"""), "y y_center y_scale")
def d19(spark, d):
    return L.position_covariates(_y(spark, d), 168)


# --- scalar functions -------------------------------------------------------------------

_SEASON = """CAST(floor((extract(month FROM l_shipdate) % 12) / 3) + 1 AS INTEGER)"""


def _ships(spark, d):
    return X.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")


@query("f1_calendar_fields", f"""SELECT l_orderkey, l_linenumber, CAST(extract(month FROM l_shipdate) AS VARCHAR)
  AS "Month", CAST(extract(day FROM l_shipdate) AS VARCHAR) AS "Day", CAST(extract(hour FROM l_shipdate) AS VARCHAR)
  AS "Hour", CAST(isodow(l_shipdate) - 1 AS VARCHAR) AS day_of_week, CAST({_SEASON} AS VARCHAR) AS season
  FROM lineitem""")
def f1(spark, d):
    return _ships(spark, d).select("l_orderkey", "l_linenumber", *[
        e.alias(n) for n, e in C.calendar_fields("l_shipdate", as_text=True).items()])


@query("f2_season", f"""SELECT l_orderkey, l_linenumber, {_SEASON} AS code, CASE {_SEASON} WHEN 1 THEN 'winter'
  WHEN 2 THEN 'spring' WHEN 3 THEN 'summer' ELSE 'autumn' END AS name FROM lineitem""")
def f2(spark, d):
    return _ships(spark, d).select("l_orderkey", "l_linenumber", C.season_code("l_shipdate").alias("code"),
                                   C.season_name("l_shipdate").alias("name"))


@query("f3_weekend", """SELECT l_orderkey, l_linenumber, CAST(CASE WHEN isodow(l_shipdate) > 5 THEN 1 ELSE 0 END AS
  TINYINT) AS is_weekend FROM lineitem""")
def f3(spark, d):
    return _ships(spark, d).select("l_orderkey", "l_linenumber", C.is_weekend("l_shipdate").alias("is_weekend"))


@query("f4_cyclic", """SELECT event_id, sin(2 * pi() * extract(hour FROM ts) / 24) AS hour_sin, cos(2 * pi() *
  extract(hour FROM ts) / 24) AS hour_cos, sin(2 * pi() * (extract(day FROM ts) - 1) / 31) AS day_sin,
  cos(2 * pi() * (extract(day FROM ts) - 1) / 31) AS day_cos FROM events""", "hour_sin hour_cos day_sin day_cos")
def f4(spark, d):
    (hs, hc), (ds, dc) = C.cyclic(F.hour("ts"), 24), C.cyclic(F.dayofmonth("ts"), 31, 1)
    return X.table(spark, d, "events").select("event_id", hs.alias("hour_sin"), hc.alias("hour_cos"),
                                              ds.alias("day_sin"), dc.alias("day_cos"))


@query("f5_clean_code", """SELECT doc_id, lower(trim(replace(source || ' область ', ' область', ''))) AS code
  FROM documents""")
def f5(spark, d):
    return X.table(spark, d, "documents").select("doc_id", N.clean_code(
        F.concat("source", F.lit(" область ")), " область").alias("code"))


@query("f6_name_order", f"""SELECT l_orderkey, l_linenumber, CAST(isodow(l_shipdate) - 1 AS INTEGER) AS dow,
  {_SEASON} AS season, CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE -1 END AS INTEGER) AS flag
  FROM lineitem""")
def f6(spark, d):
    li = X.table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     C.name_order(F.date_format("l_shipdate", "EEEE"), C.WEEKDAY_NAMES).alias("dow"),
                     C.name_order(C.season_name("l_shipdate"), C.SEASON_NAMES, 1).alias("season"),
                     N.name_map("l_returnflag", {"A": 0, "N": 1}, -1).alias("flag"))


@query("f7_to_number", """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE
  CAST(json_extract(props, '$.k') AS DOUBLE) END AS k FROM events""", "k")
def f7(spark, d):
    k = F.get_json_object("props", "$.k")
    return X.table(spark, d, "events").select("event_id", N.to_number(
        F.when(F.col("event_id") % 3 == 0, F.concat(k, F.lit(" n/a"))).otherwise(k)).alias("k"))


@query("f8_one_hot", "SELECT event_id, " + ", ".join(
    f"CAST(CASE WHEN event_type = '{e}' THEN 1 ELSE 0 END AS INTEGER) AS event_type_{e}" for e in
    ("click", "error", "purchase", "signup", "view")) + " FROM events")
def f8(spark, d):
    e = X.table(spark, d, "events").select("event_id", "event_type")
    return N.one_hot(e, N.categories(e, "event_type"))


@query("f9_undo_one_hot", "SELECT event_id, event_type FROM events")
def f9(spark, d):
    return N.undo_one_hot(f8(spark, d), "event_type")


_VOCAB = """vocab AS (SELECT name, row_number() OVER (ORDER BY name) AS code FROM (SELECT DISTINCT c_name AS name
  FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_orderdate < TIMESTAMP '1996-01-01'))"""


def _vocabulary(spark, d):
    o = X.table(spark, d, "orders").filter(F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz"))
    c = X.table(spark, d, "customer")
    return N.fit_vocabulary(c.join(o, c.c_custkey == o.o_custkey), "c_name")


@query("f10_vocabulary", with_(_VOCAB, body="SELECT name AS c_name, code FROM vocab"))
def f10(spark, d):
    return _vocabulary(spark, d)


@query("f10_vocabulary_codes", with_(_VOCAB, body="""SELECT c_custkey, c_name, coalesce(code, 0) AS code FROM
  customer LEFT JOIN vocab ON name = c_name"""))
def f10_codes(spark, d):
    c = X.table(spark, d, "customer").select("c_custkey", "c_name")
    return N.apply_vocabulary(c, _vocabulary(spark, d), "c_name", "code")


_FIT = """fit AS (SELECT event_type, CAST(user_id AS VARCHAR) AS u FROM events WHERE ts < TIMESTAMP '2024-01-16'),
  types AS (SELECT event_type, row_number() OVER (ORDER BY event_type) - 1 AS place FROM (SELECT DISTINCT event_type
  FROM fit)), users AS (SELECT u, row_number() OVER (ORDER BY u) - 1 AS place FROM (SELECT DISTINCT u FROM fit)),
  widths AS (SELECT (SELECT count(*) FROM types) AS nt, (SELECT count(*) FROM users) AS nu)"""


@query("f11_sparse_one_hot", with_(_FIT, body="""SELECT event_id, CAST(nt + nu + 3 AS INTEGER) AS width,
  CAST(coalesce(t.place, nt) AS INTEGER) AS type_place, CAST(nt + 1 + coalesce(n.place, nu) AS INTEGER) AS user_place,
  value AS last FROM events e CROSS JOIN widths LEFT JOIN types t ON t.event_type = e.event_type
  LEFT JOIN users n ON n.u = CAST(e.user_id AS VARCHAR)"""), "last")
def f11(spark, d):
    """Fitted on the first half of the month; categories first seen later share a place of their own."""
    e = X.table(spark, d, "events").select("event_id", "event_type", "user_id", "value", "ts")
    e = e.withColumn("user_id", F.col("user_id").cast("string"))
    m = N.sparse_one_hot(e.filter(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")), ["event_type", "user_id"], ["value"])
    size, at, values = N.vector_entries("features")
    v = m.transform(e).select("event_id", size.alias("width"), at.alias("at"), values.alias("x"))
    final = F.col("width") - 1
    hot = F.array_compact(F.transform("at", lambda p, i: F.when((p < final) & (F.get("x", i) == 1), p)))
    return v.select("event_id", "width", hot[0].alias("type_place"), hot[1].alias("user_place"),
                    F.when(F.element_at("at", -1) == final, F.element_at("x", -1)).otherwise(0.0).alias("last"))


@query("f12_global_standard", with_(X.s_forecasts(), """st AS (SELECT
  avg(y) AS m, stddev_pop(y) AS s FROM forecasts WHERE ts < TIMESTAMP '2024-01-20')""", body="""SELECT entity, ts,
  y, (y - m) / s AS y_z FROM forecasts, st"""), "y y_z")
def f12(spark, d):
    f = X.forecasts(spark, d).select("entity", "ts", "y")
    train = f.filter(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    return Z.apply_global(f, Z.fit_global(train, ["y"]), ["y"])


@query("f13_entity_standard", with_(X.S_USER, """tr AS (SELECT * FROM hourly WHERE ts < TIMESTAMP '2024-01-20' AND
  entity % 5 <> 0), st AS (SELECT entity, avg(y) AS m, stddev_samp(y) + 1e-6 AS s FROM tr GROUP BY 1), al AS (SELECT
  avg(y) AS am, CASE WHEN stddev_pop(y) = 0 THEN 1 ELSE stddev_pop(y) END AS asd FROM tr)""", body="""SELECT h.entity,
  ts, y, coalesce(m, am) AS norm_mean, coalesce(s, asd) AS norm_std, (y - coalesce(m, am)) / coalesce(s, asd) AS
  y_norm, y AS back FROM hourly h LEFT JOIN st ON st.entity = h.entity JOIN al ON true"""),
       "y norm_mean norm_std y_norm back")
def f13(spark, d):
    u = X.user_hourly(spark, d)
    train = u.filter((F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")) & (F.col("entity") % 5 != 0))
    per = Z.fit_by_entity(train, "entity", "y", ddof=1, guard="add")
    out = Z.apply_by_entity(u, per, Z.fit_global(train, ["y"]), "entity", "y")
    return out.withColumn("back", Z.inverse("y_norm"))


@query("f14_softplus", with_(X.S_USER, """st AS (SELECT entity, avg(y) AS m, CASE WHEN stddev_pop(y) IS NULL OR
  stddev_pop(y) = 0 THEN 1 ELSE stddev_pop(y) END AS s FROM hourly GROUP BY 1)""", body="""SELECT h.entity, ts,
  ln(1 + exp((y - m) / s)) AS soft, (y - m) / s AS back FROM hourly h JOIN st ON st.entity = h.entity"""),
       "soft back")
def f14(spark, d):
    u = X.user_hourly(spark, d)
    n = Z.apply_by_entity(u, Z.fit_by_entity(u, "entity", "y"), Z.fit_global(u, ["y"]), "entity", "y")
    soft = n.withColumn("soft", Z.softplus("y_norm"))
    return soft.select("entity", "ts", "soft", Z.softplus_inverse("soft").alias("back"))


@query("f15_bin_tokens", with_(_DENSE, _WIN.format(span=72, hold=0, stride=24), _JOINED, """sc AS (SELECT entity,
  start_idx, CASE WHEN avg(abs(y)) FILTER (k < 48) > 0 THEN avg(abs(y)) FILTER (k < 48) ELSE 1 END AS scale FROM w
  GROUP BY 1, 2), tok AS (SELECT w.entity, w.start_idx, k, CAST(least(greatest(floor((y / scale + 0.013) / 4.013 * 50)
  + 1, 1), 50) - 1 + 2 AS BIGINT) AS token FROM w JOIN sc USING (entity, start_idx) WHERE k < 48)""",
                               body="""SELECT entity, start_idx, k AS step, token FROM tok"""))
def f15(spark, d):
    g = dense(spark, d)
    w = L.window_samples(g, L.window_starts(g, 48, 24, 24), 48, 24).withColumn("scale", L.mean_abs_scale("context"))
    rows = w.select("entity", "start_idx", "scale", F.posexplode("context").alias("step", "y"))
    return rows.select("entity", "start_idx", F.col("step").cast("long").alias("step"),
                       N.bin_token(F.col("y") / F.col("scale"), -0.013, 4.0, 50, 2).alias("token"))


@query("d15_best_and_worst", with_(X.s_forecasts(), """sc AS (SELECT entity, avg(abs(y - pred)) AS mae FROM forecasts
  GROUP BY 1)""", body="""SELECT * FROM (SELECT entity, mae, 'best' AS side FROM sc ORDER BY mae, entity LIMIT 2)
  UNION ALL SELECT * FROM (SELECT entity, mae, 'worst' AS side FROM sc ORDER BY mae DESC, entity LIMIT 2)"""), "mae")
def d15(spark, d):
    return V.extremes(V.score(X.forecasts(spark, d), ["entity"]).select("entity", "mae"), "mae", 2, "entity")
