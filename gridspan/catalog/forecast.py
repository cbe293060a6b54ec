"""Queries over forecast production, model search and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as C
from ..operators import clean as K
from ..operators import evaluate as V
from ..operators import features as L
from ..operators import forecast as H
from ..operators import grid as G
from ..operators import registry as R
from ..operators import rolling as O
from ..operators import search as A
from ..plans.lineage import cut, new_path, staged
from ..spec import PANEL
from ..streaming import enrich, meter, progressive
from . import fixtures as X
from .features import dense
from .registry import query, with_

SLAB = 336

_GROWTH = """m AS (SELECT entity, avg(y) FILTER (date_trunc('month', ts) = DATE '1998-07-01') AS same, avg(y) FILTER
  (date_trunc('month', ts) = DATE '1998-06-01') AS base FROM daily GROUP BY 1), gf AS (SELECT entity, CASE WHEN base > 0
  THEN same / base ELSE 1.0 END AS growth FROM m)"""


@query("h1_monthly_baseline", with_(X.S_DAILY, _GROWTH, """tpl AS (SELECT entity, extract(day FROM ts) AS dd, avg(y)
  AS template FROM daily WHERE date_trunc('month', ts) = DATE '1999-06-01' GROUP BY 1, 2)""", body="""SELECT d.entity,
  d.ts, template, coalesce(growth, 1.0) AS growth, template * coalesce(growth, 1.0) AS pred, d.y, 3000.0 AS dam_price,
  2000.0 AS sell_bm_price, 4000.0 AS buy_bm_price FROM daily d JOIN tpl t ON t.entity = d.entity AND dd = extract(day
  FROM d.ts) LEFT JOIN gf ON gf.entity = d.entity WHERE date_trunc('month', d.ts) = DATE '1999-07-01'"""),
       "template growth pred y dam_price sell_bm_price buy_bm_price", 2)
def h1(spark, d):
    df = X.daily(spark, d).withColumn("dam_price", F.lit(3000.0)).withColumn(
        "sell_bm_price", F.lit(2000.0)).withColumn("buy_bm_price", F.lit(4000.0))
    return H.monthly_baseline(df, "1999-07-01")


@query("h2_seasonal_lag", with_(X.S_GRID, body="""SELECT entity, ts, y, time_idx, lag(y, 168) OVER (PARTITION BY
  entity ORDER BY ts) AS pred FROM grid"""), "y pred")
def h2(spark, d):
    return H.seasonal_lag(X.full(spark, d), 168, size=SLAB)


_ROLL = """lagged AS (SELECT *, lag(y, 24) OVER w AS l24, lag(y, 48) OVER w AS l48 FROM grid WINDOW w AS (PARTITION BY
  entity ORDER BY ts)), rolled AS (SELECT entity, ts, y, time_idx, 240 + (time_idx - 240) // 48 * 48 - 1 AS origin_idx,
  time_idx - (240 + (time_idx - 240) // 48 * 48 - 1) AS lead, l24, l48 FROM lagged WHERE time_idx >= 240)"""


@query("h14_rolling_seasonal", with_(X.S_GRID, _ROLL, body="""SELECT entity, ts, y, time_idx, origin_idx, lead,
  CASE WHEN lead <= 24 THEN l24 ELSE l48 END AS pred FROM rolled"""), "y pred")
def h14(spark, d):
    return H.rolling_seasonal(X.full(spark, d), 240, size=SLAB)


@query("q22_keep_first_forecast", with_(X.S_GRID, _ROLL, body="""SELECT entity, time_idx, min(origin_idx) AS origin_idx,
  arg_min(p, origin_idx) AS pred FROM (SELECT entity, time_idx, origin_idx, coalesce(l24, -1.0) AS p FROM rolled
  UNION ALL SELECT entity, time_idx, origin_idx + 24, coalesce(l48, -1.0) FROM rolled) GROUP BY 1, 2"""), "pred")
def q22(spark, d):
    g = L.lag_columns(X.full(spark, d), [24, 48], size=SLAB)
    r = H.rolling_origins(g, 240)
    early = r.select("entity", "time_idx", "origin_idx", F.coalesce("lag_24", F.lit(-1.0)).alias("pred"))
    late = r.select("entity", "time_idx", (F.col("origin_idx") + 24).alias("origin_idx"),
                    F.coalesce("lag_48", F.lit(-1.0)).alias("pred"))
    return H.dedupe_forecasts(early.unionByName(late), "first")


def _history(spark, d, last: int = 600):
    return dense(spark, d).filter(F.col("time_idx") <= last)


def _future(spark, d, first: int = 600):
    return dense(spark, d).filter(F.col("time_idx") > first).drop("y")


_RAW = """mean24 AS (SELECT *, lag(y, 48) OVER w AS l48, lag(y, 168) OVER w AS l168 FROM grid WINDOW w AS (PARTITION
  BY entity ORDER BY ts))"""
_DENSE = X.S_GRID.replace(" grid AS (", " grid0 AS (") + """, grid AS (SELECT entity, ts, coalesce(y, 0.0) AS y,
  time_idx FROM grid0)"""
_LAGS = """lagged AS (SELECT *, lag(y, 48) OVER w AS l48, lag(y, 168) OVER w AS l168 FROM grid WINDOW w AS (PARTITION
  BY entity ORDER BY ts))"""


def _fit(until: int) -> str:
    """Least squares of y on its lags 48 and 168 over the steps up to ``until``, by the two normal equations."""
    return f"""cov AS (SELECT covar_pop(l48, l48) AS aa, covar_pop(l48, l168) AS ab, covar_pop(l168, l168) AS bb,
  covar_pop(l48, y) AS ay, covar_pop(l168, y) AS yb, avg(l48) AS ma, avg(l168) AS mb, avg(y) AS my FROM lagged
  WHERE time_idx <= {until} AND l48 IS NOT NULL AND l168 IS NOT NULL AND y IS NOT NULL),
  ab AS (SELECT *, (ay * bb - yb * ab) / (aa * bb - ab * ab) AS b48, (yb * aa - ay * ab) / (aa * bb - ab * ab) AS b168
  FROM cov), fit AS (SELECT b48, b168, my - b48 * ma - b168 * mb AS b0 FROM ab)"""


def _chunks(first: int, chunk: int, n: int) -> str:
    """Steps after ``first`` in chunks; each reads what the chunks before it predicted."""
    parts = [f"known0 AS MATERIALIZED (SELECT entity, time_idx, y AS v FROM grid WHERE time_idx <= {first})"]
    for k in range(1, n + 1):
        a, b = first + 1 + (k - 1) * chunk, first + k * chunk
        parts.append(f"""v{k} AS MATERIALIZED (SELECT f.entity, f.ts, f.time_idx, greatest(0.0, b0 + b48 * a.v + b168 * b.v)
  AS pred FROM grid f CROSS JOIN fit LEFT JOIN known{k - 1} a ON a.entity = f.entity AND a.time_idx = f.time_idx - 48
  LEFT JOIN known{k - 1} b ON b.entity = f.entity AND b.time_idx = f.time_idx - 168 WHERE f.time_idx BETWEEN {a} AND {b}),
  known{k} AS MATERIALIZED (SELECT * FROM known{k - 1} UNION ALL SELECT entity, time_idx, pred FROM v{k})""")
    return ", ".join(parts)


def _all(n: int) -> str:
    return " UNION ALL ".join(f"SELECT entity, ts, time_idx, pred FROM v{k}" for k in range(1, n + 1))


def _fitted(spark, d, until: int):
    """Coefficients over the lags of the dense panel up to a step."""
    rows = L.lag_features(dense(spark, d), lags=(48, 168), windows=(), diffs=(), size=SLAB)
    return O.fit_linear(rows.filter(F.col("time_idx") <= until), ["lag_48h", "lag_168h"], "y")


def _scorer(spark, d):
    return H.linear_scorer(*_fitted(spark, d, 600), lags=(48, 168), windows=(), diffs=(), size=SLAB)


@query("h15_recursive_linear", with_(_DENSE, _LAGS, _fit(600), _chunks(600, 48, 6), body=_all(6)), "pred")
def h15(spark, d):
    """A model fitted on the history, recursively over every step that is left."""
    r = H.recursive_forecast(_history(spark, d), _future(spark, d), _scorer(spark, d), None, 200)
    return r.select("entity", "ts", "time_idx", "pred")


@query("h16_recursive_fleet", with_(_DENSE, _LAGS, _fit(600), _chunks(600, 24, 12), body=_all(12)), "pred")
def h16(spark, d):
    out = H.recursive_forecast(_history(spark, d), _future(spark, d), _scorer(spark, d), None, 200, chunk=24)
    path = new_path(spark, "fleet")
    out.select("entity", "ts", "time_idx", "pred").write.parquet(path)
    return spark.read.parquet(path)


_ROLLED = """SELECT entity, ts, time_idx, y, 480 + (time_idx - 480) // 48 * 48 - 1 AS origin_idx, time_idx - (480 + (time_idx
  - 480) // 48 * 48 - 1) AS lead, {pred} AS pred FROM lagged {more} WHERE time_idx >= 480"""


@query("h14_rolling_linear", with_(_DENSE, _LAGS, _fit(479), body=_ROLLED.format(
    pred="greatest(0.0, b0 + b48 * l48 + b168 * l168)", more="CROSS JOIN fit")), "y pred")
def h14_linear(spark, d):
    weights, intercept = _fitted(spark, d, 479)
    return O.rolling_evaluation(dense(spark, d), O.linear_origins(weights, intercept, (48, 168)), 168, 480, size=SLAB)


@query("h14_rolling_batch", with_(_DENSE, _LAGS, body=_ROLLED.format(pred="0.5 * l48 + 0.5 * l168", more="")), "y pred")
def h14_batch(spark, d):
    """A sequence model called on batches of contexts."""
    def mean_of_two(contexts, _):
        return 0.5 * contexts[:, -48:] + 0.5 * contexts[:, -168:-120]
    return O.rolling_evaluation(dense(spark, d), O.batch_origins(mean_of_two), 168, 480, size=SLAB)


@query("h14_rolling_trees")
def h14_trees(spark, d):
    """Boosted trees fitted on the steps before the first origin, scored at every origin."""
    from ..operators import trees
    lags, names = (48, 72, 168), ["lag_48h", "lag_72h", "lag_168h"]
    rows = L.lag_features(dense(spark, d), lags=lags, windows=(), diffs=(), size=SLAB)
    model = trees.fit_trees(rows.filter("time_idx < 480"), names, categories=["entity"], **_SMALL)
    keep = ["entity", "ts", "time_idx", "y", "origin_idx", "lead"]
    scorer = O.model_origins(lambda r: trees.predict(model, r, names, keep, categories=["entity"]), lags)
    return O.rolling_evaluation(dense(spark, d), scorer, 168, 480, size=SLAB)


_SHORT = """few AS (SELECT entity, min(ts) AS t, min(time_idx) AS a, count(y) AS n, avg(y) AS m FROM indexed
  GROUP BY 1)"""


@query("h17_pad_short_history", with_(X.S_USER, _SHORT, body="""SELECT entity, ts, y, time_idx FROM indexed UNION ALL
  SELECT entity, t - k * INTERVAL 1 HOUR, m, a - k FROM (SELECT *, unnest(generate_series(1, 60 - n)) AS k FROM few
  WHERE n < 60)"""), "y")
def h17(spark, d):
    return H.seed_history(X.user_indexed(spark, d), 60)


@query("h17_skip_short_history", with_(X.S_USER, _SHORT, body="""SELECT entity, ts, y, time_idx FROM indexed WHERE
  entity IN (SELECT entity FROM few WHERE n >= 60)"""), "y")
def h17_skip(spark, d):
    return H.seed_history(X.user_indexed(spark, d), 60, policy="skip")


@query("h19_whole_final_day", """SELECT o_orderkey, e, CASE WHEN e = date_trunc('day', e) THEN e + INTERVAL 23 HOUR
  + INTERVAL 59 MINUTE ELSE e END AS inclusive_end FROM (SELECT o_orderkey, o_orderdate + (o_orderkey % 3)
  * INTERVAL 5 HOUR AS e FROM orders)""")
def h19(spark, d):
    o = X.table(spark, d, "orders").select("o_orderkey", C.add_steps(
        F.col("o_orderdate"), F.col("o_orderkey") % 3 * 5).alias("e"))
    return o.withColumn("inclusive_end", C.whole_final_day("e"))


@query("h20_bucket_index", """SELECT c_custkey AS entity, CAST(r // 110 AS INTEGER) AS bucket, 'EIC ' || (r // 110 * 110
  + 1) || '–' || least(r // 110 * 110 + 110, n) AS label FROM (SELECT c_custkey, row_number() OVER (ORDER BY
  c_custkey) - 1 AS r, count(*) OVER () AS n FROM customer)""")
def h20(spark, d):
    return H.bucket_index(X.table(spark, d, "customer").select(F.col("c_custkey").alias("entity")))


@query("h20_bucketed_export", with_(X.S_USER, body="""SELECT CAST(r // 110 AS INTEGER) AS bucket, count(*) AS rows FROM
  hourly JOIN (SELECT entity, row_number() OVER (ORDER BY entity) - 1 AS r FROM (SELECT DISTINCT entity FROM hourly))
  USING (entity) GROUP BY 1"""))
def h20_export(spark, d):
    path = new_path(spark, "buckets")
    H.export_buckets(X.user_hourly(spark, d), path)
    return spark.read.parquet(path).groupBy("bucket").agg(F.count("*").alias("rows"))


# --- search over entities ---------------------------------------------------------------

def _priced(spark, d):
    return dense(spark, d).join(X.prices(spark, d), "ts", "left").select(
        "entity", "ts", "y", "time_idx", *[F.coalesce(c, F.lit(1000.0)).alias(c) for c in
                                          ("dam_price", "sell_bm_price", "buy_bm_price")],
        F.hour("ts").alias("Hour"), F.weekday("ts").alias("day_of_week"))


EXOG = ("dam_price", "Hour", "day_of_week")


def _split(spark, d):
    p = cut(_priced(spark, d))
    return p.filter("time_idx < 600"), p.filter("time_idx >= 600"), p


@query("h3_decompose_forecast")
def h3(spark, d):
    """Validation from training, test from both, a row and a status for every entity and step."""
    train, later, _ = _split(spark, d)
    chosen = train.select("entity").distinct().withColumn("order_id", F.lit(2))
    return A.forecast_splits(train, later.filter("time_idx < 660"), later.filter("time_idx >= 660"), chosen, EXOG, size=SLAB)


@query("h4_load_shape_clusters")
def h4(spark, d):
    return A.cluster_entities(X.user_hourly(spark, d), clusters=15)


@query("h5_cluster_search")
def h5(spark, d):
    train, val, _ = _split(spark, d)
    clusters = A.cluster_entities(train, clusters=3)
    return A.cluster_search(train, val, clusters, exog=EXOG, size=SLAB)


@query("h6_entity_search")
def h6(spark, d):
    train, val, _ = _split(spark, d)
    return A.entity_search(train, val, exog=EXOG, size=SLAB)


@query("h6_common_order")
def h6_common(spark, d):
    train, _, _ = _split(spark, d)
    return A.common_order(train, exog=EXOG, size=SLAB)


@query("h7_fit_and_score_fleet")
def h7(spark, d):
    """Every entity fitted and scored, all its products summed by Spark."""
    train, val, _ = _split(spark, d)
    chosen = train.select("entity").distinct().withColumn("order_id", F.lit(0))
    f = A.forecast_with_orders(train, val.drop("y"), chosen, A.reach(train, val), EXOG, size=SLAB)
    return V.score(f.drop("ts").join(val, ["entity", "time_idx"]), ["entity", "status"])


# --- trees --------------------------------------------------------------------------------

#: The entity and an attribute of it.
_CATEGORIES = ["entity", "station_type"]


def _tree_data(spark, d, outages=False):
    """Features of every row, unknown lags too; the first 600 steps are for training."""
    from ..operators import trees
    p, names = trees.tree_features(_priced(spark, d).drop("Hour", "day_of_week"), outages=outages, size=SLAB,
                                   minimum=4)
    kinds = X.readings(spark, d).groupBy("entity").agg(
        F.concat(F.lit("T"), (F.count("*") % 3).cast("string")).alias("station_type"))
    p = staged(p.join(kinds, "entity"), "tree-rows")
    return p.filter("time_idx < 600"), p.filter("time_idx >= 600"), names


_SMALL = {"maxIter": 3, "maxDepth": 3, "seed": 7}


@query("h8_boosted_trees")
def h8(spark, d):
    from ..operators import trees
    train, val, names = _tree_data(spark, d)
    model = trees.fit_trees(train, names, categories=_CATEGORIES, **_SMALL)
    return V.score(trees.predict(model, val, names, ["entity", "y", "dam_price", "sell_bm_price", "buy_bm_price"],
                                 _CATEGORIES), ["entity"])


@query("h8_categories_and_unknowns", with_(_DENSE, """lagged AS (SELECT *, lag(y, 48) OVER (PARTITION BY entity ORDER BY
  ts) IS NULL AS gap FROM grid)""", body="""SELECT entity, ts, avg(y) OVER (PARTITION BY entity, gap) AS pred
  FROM lagged"""), "pred")
def h8_categories(spark, d):
    """One tree deep enough for a leaf per entity and per known or unknown lag: its predictions are the groups' means."""
    from ..operators import trees
    rows = L.lag_columns(dense(spark, d), [48], size=SLAB).withColumn("zero", F.when(F.col("lag_48").isNotNull(), 0.0))
    model = trees.fit_trees(rows, ["zero"], categories=["entity"], maxIter=1, maxDepth=8, seed=7)
    return trees.predict(model, rows, ["zero"], ["entity", "ts"], ["entity"])


@query("h9_cost_scored_search")
def h9(spark, d):
    from ..operators import trees
    train, val, names = _tree_data(spark, d)
    return trees.search_trees(train, val, names, {"maxDepth": [2, 3], "maxIter": [2], "stepSize": [0.1, 0.3]}, 2,
                              categories=_CATEGORIES)[1]


@query("h10_early_stopping")
def h10(spark, d):
    from ..operators import trees
    train, val, names = _tree_data(spark, d)
    both = train.withColumn("is_val", F.col("time_idx") >= 500)
    model = trees.fit_trees(both, names, validation="is_val", categories=_CATEGORIES, maxIter=5, maxDepth=2, seed=7)
    return trees.predict(model, val, names, ["entity", "ts", "y"], _CATEGORIES)


@query("h11_importances")
def h11(spark, d):
    from ..operators import trees
    train, _, names = _tree_data(spark, d)
    return trees.importances(trees.fit_trees(train, names, categories=_CATEGORIES, **_SMALL))


@query("h12_outage_ablation")
def h12(spark, d):
    from ..operators import trees
    train, val, names = _tree_data(spark, d, outages=True)
    return trees.ablation(train, val, names, ["outage"], categories=_CATEGORIES, **_SMALL)


@query("h13_direct_scoring")
def h13(spark, d):
    from ..operators import trees
    train, val, names = _tree_data(spark, d)
    model = trees.fit_trees(train, names, categories=_CATEGORIES, **_SMALL)
    return trees.predict(model, val, names, ["entity", "ts", "dam_price", "buy_bm_price", "sell_bm_price"], _CATEGORIES)


@query("h18_registry_forecast", with_(_DENSE, _RAW, body="""SELECT entity, ts, l48 AS pred FROM mean24 WHERE ts >=
  TIMESTAMP '2024-01-20' AND ts < TIMESTAMP '2024-01-22'"""), "pred")
def h18(spark, d):
    registry = R.ForecasterRegistry()
    registry.register("lag_48", lambda panel, start, end: H.seasonal_lag(panel, 48, size=SLAB))
    return registry.forecast("lag_48", dense(spark, d), "2024-01-20", "2024-01-21").select("entity", "ts", "pred")


@query("h18_batch_scorer", with_(_DENSE, _RAW, body="""SELECT entity, ts, 0.5 * l48 + 0.5 * l168 AS pred FROM mean24
  WHERE l168 IS NOT NULL"""), "pred")
def h18_batch(spark, d):
    rich = L.lag_columns(dense(spark, d), [48, 168], size=SLAB).dropna()
    score = R.batch_scorer(lambda x: 0.5 * x["lag_48"] + 0.5 * x["lag_168"], ["lag_48", "lag_168"], ["entity", "ts"])
    return score(rich)


@query("v2_group_function", with_(X.S_USER, body="""SELECT entity, max(y) - min(y) AS spread FROM (SELECT *,
  row_number() OVER (PARTITION BY entity ORDER BY ts DESC) AS rn FROM hourly) WHERE rn <= 24 GROUP BY 1"""), "spread")
def v2(spark, d):
    recent = K.last_rows(X.user_hourly(spark, d), 24)
    return R.group_apply(recent, ["entity"], lambda g: g.groupby("entity", as_index=False)["y"].agg(
        lambda s: s.max() - s.min()).rename(columns={"y": "spread"}), "entity long, spread double")


# --- streams -----------------------------------------------------------------------------

@query("s1_resumable_enrichment", """SELECT c_custkey, c_nationkey, n_name FROM customer JOIN nation ON c_nationkey =
  n_nationkey""")
def s1(spark, d):
    c, n = X.table(spark, d, "customer"), X.table(spark, d, "nation")
    landed, out, mark = (new_path(spark, s) for s in ("landed", "rich", "mark"))
    part = c.select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    part.filter("c_custkey % 2 = 0").write.parquet(f"{landed}/a")
    rich = lambda b: b.join(n.select("n_nationkey", "n_name"), "n_nationkey").select(
        "c_custkey", F.col("n_nationkey").alias("c_nationkey"), "n_name")
    for step in ("a", "b"):
        if step == "b":
            part.write.parquet(f"{landed}/b")
        stream = spark.readStream.schema(part.schema).option("recursiveFileLookup", "true").parquet(landed)
        enrich.enrich_available(stream, ["c_custkey"], rich, out, mark)
    return spark.read.parquet(out).drop("batch")


def _progressive_rows(spark, d):
    g = L.lag_columns(dense(spark, d), [48, 168], size=SLAB).dropna()
    s, c = C.cyclic(F.hour("ts"), 24)
    return g.select("entity", "ts", "y", "lag_48", "lag_168", s.alias("hour_sin"), c.alias("hour_cos"))


@query("s2_predict_then_learn")
def s2(spark, d):
    rows = _progressive_rows(spark, d)
    p = progressive.predict_then_learn(rows, ["lag_48", "lag_168", "hour_sin", "hour_cos"])
    return V.score_days(p, "ts")


@query("s4_meter_stream", with_("lim AS (SELECT max(ts) - INTERVAL 2 HOUR AS w FROM events)", X.S_HOURLY,
                                body="""SELECT entity, h.ts, y, dam_price FROM hourly h JOIN lim ON h.ts + INTERVAL
  1 HOUR <= w JOIN (SELECT date_trunc('hour', ts) AS ts, 1000 + 10 * avg(value) AS dam_price FROM events GROUP BY 1) p
  ON p.ts = h.ts"""), "y dam_price")
def s4(spark, d):
    e = X.table(spark, d, "events")
    landed, out, mark = (new_path(spark, s) for s in ("readings", "hours", "mark"))
    e.write.parquet(f"{landed}/a")
    e.filter("event_id % 5 = 0").write.parquet(f"{landed}/b")  # repeated deliveries
    stream = spark.readStream.schema(e.schema).option("recursiveFileLookup", "true").parquet(landed)
    hours = meter.hourly_stream(stream, "event_type", "ts", "value", ["event_id"])
    prices = X.prices(spark, d).select(F.col("ts").cast("timestamp").alias("ts"), "dam_price")
    meter.write_available(meter.enrich_static(hours, prices, ["ts"]), out, mark)
    return spark.read.parquet(out).select("entity", F.col("ts").cast("timestamp_ntz").alias("ts"), "y", "dam_price")
