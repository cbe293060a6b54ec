"""Hand-computed cases of the decided semantics."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridspan.functions import calendar as C
from gridspan.functions import encode as N
from gridspan.functions import metrics as M
from gridspan.functions import timezone as Z
from gridspan.operators import build as B
from gridspan.operators import clean as K
from gridspan.operators import evaluate as V
from gridspan.operators import forecast as H
from gridspan.operators import grid as G
from gridspan.operators import joins as J
from gridspan.operators.registry import ForecasterFailed, ForecasterRegistry, UnknownForecaster
from gridspan.sources import payloads, prices, readings
from gridspan.spec import GOLD, SchemaError, gold_schema, require_columns

H1 = dt.timedelta(hours=1)
T0 = dt.datetime(2024, 1, 1)


def ts(df, *names):
    for n in names:
        df = df.withColumn(n, F.col(n).cast("timestamp_ntz"))
    return df


def hours(spark, values, entity="a", start=T0):
    return ts(spark.createDataFrame([(entity, str(start + i * H1), v) for i, v in values],
                                    "entity string, ts string, y double"), "ts")


def test_cost_example(spark):
    rows = [(10.0, p, 5000.0, 3000.0, 7000.0) for p in (10.0, 11.5, 8.5, 10.05)]
    df = spark.createDataFrame(rows, "y double, pred double, dam_price double, sell_bm_price double, "
                                     "buy_bm_price double")
    got = df.agg(M.money().alias("m"), M.money_pct().alias("p"), F.max(M.ideal_spend()).alias("i")).first()
    assert got.m == pytest.approx(6.1) and got.p == pytest.approx(3.05) and got.i == pytest.approx(50)
    assert df.withColumn("pred", F.col("y")).agg(M.money()).first()[0] == 0


def test_metric_corners(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0), (2.0, 1.0)], "y double, pred double")
    got = df.agg(M.smape("y", "pred").alias("s"), M.mape("y", "pred").alias("a"),
                 M.rmse("y", "pred").alias("r"), M.bias("y", "pred").alias("b")).first()
    assert got.s == pytest.approx((0 + 2 + 1 / 1.5) / 3 * 100)
    assert got.a == pytest.approx(50) and got.r == pytest.approx((2 / 3) ** 0.5) and got.b == 0


def test_solar_is_active_after_the_install_day(spark):  # Q1
    df = hours(spark, [(23, 1.0), (24, 1.0), (47, 1.0)])
    inst = ts(spark.createDataFrame([("a", "2024-01-01 00:00:00", 7.0)], "entity string, since string, power double"),
              "since")
    got = J.effective_value(df, inst, "since", "power").orderBy("ts").collect()
    assert [r.max_solar for r in got] == [0.0, 7.0, 7.0]


@pytest.mark.parametrize("slab_days", [1, 84])
def test_charger_counts_from_its_start(spark, slab_days):  # Q2, Q3
    df = hours(spark, [(0, 1.0), (1, 1.0), (2, 1.0), (2, 1.0)])
    inst = ts(spark.createDataFrame([("a", str(T0 + H1), 5.0), ("a", str(T0 + 2 * H1), 2.0), ("a", None, 9.0),
                                     ("b", str(T0), 4.0)], "entity string, since string, power double"), "since")
    got = J.effective_sum(df, inst, "since", "power", slab_days=slab_days).collect()
    assert sorted(r.max_ev for r in got) == [0.0, 5.0, 7.0, 7.0]  # a repeated row is not doubled


def test_season_codes(spark):  # Q4
    df = spark.sql("select explode(sequence(1, 12)) m").select(
        F.make_timestamp(F.lit(2024), "m", F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias("t"))
    got = df.select(C.season_code("t").alias("c"), C.season_name("t").alias("n")).collect()
    assert [r.c for r in got] == [1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 4, 1]
    assert got[0].n == "winter" and got[8].n == "autumn"


def test_tail_block_is_kept_not_the_longest(spark):  # Q5, Q6, Q7
    long_then_short = [(i, 1.0) for i in [*range(0, 200), *range(210, 240)]]
    df = G.index_from(hours(spark, long_then_short))
    kept = G.trim_to_tail(df, max_missing=3, min_days=1, size=50)
    assert sorted(r.time_idx for r in kept.collect()) == list(range(210, 240))
    assert G.trim_to_tail(df, max_missing=3, min_days=2, size=50).count() == 0  # 29 h is 1 whole day
    assert G.trim_to_tail(df, max_missing=10, min_days=2, size=50).count() == 230


def test_date_rows_of_reports_are_not_hours(spark):  # Q9, Q10
    lines = spark.createDataFrame([
        ("f", 1, "2024-10-27", None), ("f", 2, "1", 10.0), ("f", 3, "4", 40.0), ("f", 4, "5", 50.0),
        ("f", 5, "Grand Total", 99.0)], "file string, line long, label string, dam double")
    naive = prices.report_to_hours(lines, "file", "line", "label", ["dam"], size=2).orderBy("ts").collect()
    assert [(r.ts.hour, r.dam) for r in naive] == [(0, 10.0), (3, 40.0), (4, 50.0)]
    utc = prices.report_to_hours(lines, "file", "line", "label", ["dam"], zone="Europe/Kyiv").orderBy("ts").collect()
    assert [(str(r.ts), r.dam) for r in utc] == [("2024-10-26 21:00:00", 10.0), ("2024-10-27 02:00:00", 50.0)]


@pytest.mark.parametrize("local, ambiguous, nonexistent, want", [
    ("2024-10-27 03:30", "earliest", "null", "2024-10-27 00:30:00"),
    ("2024-10-27 03:30", "latest", "null", "2024-10-27 01:30:00"),
    ("2024-10-27 03:30", "null", "null", None),
    ("2024-10-27 02:59", "null", "null", "2024-10-26 23:59:00"),
    ("2024-10-27 04:00", "null", "null", "2024-10-27 02:00:00"),
    ("2024-03-31 03:30", "null", "shift_forward", "2024-03-31 01:00:00"),
    ("2024-03-31 03:30", "null", "null", None),
    ("2024-03-31 04:00", "null", "null", "2024-03-31 01:00:00"),
])
def test_clock_changes(spark, local, ambiguous, nonexistent, want):  # Q10
    df = spark.createDataFrame([(local,)], "t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    got = df.select(Z.to_utc("t", "Europe/Kyiv", ambiguous, nonexistent)).first()[0]
    assert (str(got) if got else None) == want


@pytest.mark.parametrize("local", ["2024-10-27 03:30", "2024-03-31 03:30"])
def test_clock_changes_raise(spark, local):
    df = spark.createDataFrame([(local,)], "t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    with pytest.raises(Exception, match="local time"):
        df.select(Z.to_utc("t", "Europe/Kyiv", "raise", "raise")).collect()


def test_price_gap_takes_its_own_past(spark):  # Q11
    p = hours(spark, [(0, 5.0), (1, None), (4, 8.0)]).select("ts", F.col("y").alias("dam"))
    got = G.complete_time_table(p, columns=["dam"], size=2).orderBy("ts").collect()
    assert [r.dam for r in got] == [5.0, 5.0, 5.0, 5.0, 8.0]


def test_interpolation_ends(spark):  # Q12, Q27
    df = hours(spark, [(0, None), (1, 2.0), (4, 8.0), (5, None)]).unionByName(
        hours(spark, [(0, None), (1, None)], "b"))
    g = G.full_grid(df, size=3)
    got = G.interpolate(g, ["y"], size=3).filter("entity = 'a'").orderBy("ts").collect()
    assert [r.y for r in got] == [None, 2.0, 4.0, 6.0, 8.0, 8.0]
    both = G.interpolate(g, ["y"], both_ends=True, size=3)
    assert [r.y for r in both.filter("entity = 'a'").orderBy("ts").collect()][0] == 2.0
    assert [r.y for r in both.filter("entity = 'b'").collect()] == [0.0, 0.0]


def test_splits_are_half_open(spark):  # Q13
    df = ts(spark.createDataFrame([("2025-06-30 23:00:00",), ("2025-07-01 00:00:00",), ("2025-07-31 23:00:00",),
                                   ("2025-08-01 00:00:00",)], "ts string"), "ts")
    got = G.label_splits(df, "2025-07-01", "2025-08-01").orderBy("ts").collect()
    assert [r.data_subset for r in got] == ["train", "val", "val", "test"]


def test_extension_adds_only_absent_rows(spark):  # Q14
    df = hours(spark, [(0, 1.0), (1, 2.0)])
    got = G.extend(df, str(T0 + H1), str(T0 + 3 * H1))
    assert got.count() == 4 and got.filter("y is null").count() == 2
    with pytest.raises(G.WindowError):
        G.extend(df, "2023-12-31", "2024-01-02")


def test_forecast_choice_by_origin(spark):  # Q22
    df = spark.createDataFrame([("a", 5, 1, 10.0), ("a", 5, 3, 30.0)],
                               "entity string, time_idx long, origin_idx long, pred double")
    assert H.dedupe_forecasts(df, "first").first().pred == 10.0
    assert H.dedupe_forecasts(df, "last").first().pred == 30.0


def test_first_forecast_row_is_one_step_after_origin(spark):  # Q26
    df = G.index_from(hours(spark, [(i, float(i)) for i in range(200)]))
    got = H.rolling_origins(df, 100).filter("time_idx in (100, 147, 148)").orderBy("time_idx").collect()
    assert [(r.origin_idx, r.lead) for r in got] == [(99, 1), (99, 48), (147, 1)]


def test_vocabulary_is_fit_on_the_given_frame(spark):  # Q23
    fit = spark.createDataFrame([("b",), ("a",), ("a",), (None,)], "v string")
    new = spark.createDataFrame([("a",), ("z",), (None,)], "v string")
    vocab = N.fit_vocabulary(fit, "v")
    assert {r.v: r.code for r in vocab.collect()} == {"a": 1, "b": 2}
    assert {r.v: r.code for r in N.apply_vocabulary(new, vocab, "v", "code", unknown=-1).collect()} == {
        "a": 1, "z": -1, None: -1}


def test_too_many_categories_are_refused(spark):
    with pytest.raises(N.TooManyCategories):
        N.categories(spark.range(20).withColumn("c", F.col("id").cast("string")), "c", limit=10)


def test_alarm_minutes_are_those_under_any_alarm(spark):
    df = ts(spark.createDataFrame([
        ("r", "2024-01-01 10:00", "2024-01-01 10:20"), ("r", "2024-01-01 10:10", "2024-01-01 10:20"),
        ("r", "2024-01-01 10:50", "2024-01-01 11:05"), ("s", "2024-01-01 23:30", "2024-01-02 00:15"),
        ("t", "2024-01-01 23:45", None), ("u", None, None)], "region_id string, start string, end string"),
        "start", "end")
    got = {(r.region_id, r.ts.day, r.ts.hour): (r.alarms, r.minutes) for r in J.alarm_hours(df).collect()}
    assert got == {("r", 1, 10): (3, 30.0), ("r", 1, 11): (1, 5.0), ("s", 1, 23): (1, 30.0), ("s", 2, 0): (1, 15.0),
                   ("t", 1, 23): (1, 15.0), ("t", 2, 0): (1, 15.0)}


def test_weather_copies_are_taken_whole(spark):
    df = hours(spark, [(0, 1.0)]).select("*", F.lit(50.0).alias("latitude"), F.lit(30.0).alias("longitude"))
    w = ts(spark.createDataFrame([(str(T0), 1, 9.0, 1.0), (str(T0), 2, None, 5.0)], "ts string, o int, t double, r double"),
           "ts").select("*", F.lit(50.0).alias("latitude"), F.lit(30.0).alias("longitude"))
    got = J.fill_weather(df, w, ["t", "r"], order="o").first()
    assert (got.t, got.r) == (None, 5.0)


def test_all_categories_without_a_limit(spark):
    many = spark.range(500).withColumn("c", F.col("id").cast("string"))
    assert len(N.categories(many, "c")["c"]) == 500


def test_recursive_equals_direct_within_one_chunk(spark):
    df = G.index_from(hours(spark, [(i, float(i % 24)) for i in range(400)]))
    past, future = df.filter("time_idx < 360"), df.filter("time_idx >= 360").drop("y")
    scorer = H.linear_scorer({"lag_48h": 1.0}, lags=(48,), windows=(), diffs=(), size=100)
    rec = H.recursive_forecast(past, future, scorer, 40, 100)
    direct = scorer(past.unionByName(future.withColumn("y", F.lit(None).cast("double"))))
    assert sorted(map(tuple, rec.collect())) == sorted(map(tuple, direct.select(rec.columns).collect()))
    chunks = H.recursive_forecast(past, future, scorer, 40, 100, chunk=16)
    assert sorted(map(tuple, rec.collect())) == sorted(map(tuple, chunks.select(rec.columns).collect()))


def test_entities_with_different_ends(spark):
    a = hours(spark, [(i, 1.0) for i in range(100)], "a")
    b = hours(spark, [(i, 2.0) for i in range(120)], "b")
    df = G.index_from(a.unionByName(b))
    future = G.index_from(G.spine(df, str(T0 + 100 * H1), str(T0 + 140 * H1)), str(T0))
    scorer = H.linear_scorer({"lag_48h": 1.0}, lags=(48,), windows=(), diffs=(), size=64)
    got = H.recursive_forecast(df, future, scorer, 10, 60).groupBy("entity").agg(
        F.min("time_idx").alias("a"), F.max("time_idx").alias("b"), F.max("pred").alias("p")).collect()
    assert {(r.entity, r.a, r.b, r.p) for r in got} == {("a", 100, 109, 1.0), ("b", 120, 129, 2.0)}


def test_registry_errors(spark):
    df = hours(spark, [(0, 1.0)])
    reg = ForecasterRegistry()
    reg.register("bad", lambda p, s, e: 1 / 0)
    reg.register("empty", lambda p, s, e: p)
    with pytest.raises(UnknownForecaster):
        reg.forecast("none", df, "2024-01-01", "2024-01-02")
    for name in ("bad", "empty"):
        with pytest.raises(ForecasterFailed):
            reg.forecast(name, df, "2024-01-01", "2024-01-02")
    with pytest.raises(SchemaError):
        reg.forecast("bad", df.drop("y"), "2024-01-01", "2024-01-02")


def test_schema_checks(spark):
    with pytest.raises(SchemaError):
        require_columns(spark.range(1), ["nope"])
    gold = gold_schema()
    assert {GOLD.entity, GOLD.ts, GOLD.y, GOLD.idx} <= set(gold.names) and len(gold) == 38


def test_payload_padding(spark):
    text = '{"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00", "bad"], "rain": [1.5], "x": [1,2,3,4]}}'
    df = spark.createDataFrame([(text,), ('{"hourly": {}}',), ("junk",)], "p string")
    got = payloads.hourly_rows(df, "p", ["rain", "x", "snowfall"]).orderBy("ts").collect()
    assert [(r.ts.hour, r.rain, r.x, r.snowfall) for r in got] == [(0, 1.5, 1.0, None), (1, None, 2.0, None)]


def test_sheet_heads_are_skipped(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Report 2025\n\nRegion: all\nEIC,Date,Hour,kWh\n62Z1,2025-01-01,3,1.5\n"
                                    "62Z1,2025-01-01,,2.5\nGrand Total,2025-01-01,,4\n", encoding="utf-8")
    raw = readings.read_sheets(spark, str(tmp_path), {"EIC": "entity", "Date": "date", "Hour": "hour", "kWh": "y"},
                               {"hour": "int", "y": "double"})
    got = readings.conform_readings(raw).orderBy("ts").collect()
    assert [(r.entity, str(r.ts), r.y) for r in got] == [
        ("62Z1", "2025-01-01 00:00:00", 2.5), ("62Z1", "2025-01-01 03:00:00", 1.5)]


def test_rules_keep_unknown_entities(spark):
    df = hours(spark, [(0, 300.0), (48, 300.0)]).unionByName(hours(spark, [(0, 300.0)], "b"))
    rules = K.rules_frame(spark, {"a": "2024-01-02"}, {"a": 210.0})
    assert sorted((r.entity, r.y) for r in K.apply_rules(df, rules).collect()) == [("a", 210.0), ("b", 300.0)]


def test_build_in_local_time_has_no_gap(spark):
    start = dt.datetime(2024, 3, 30)
    local = [start + i * H1 for i in range(72) if start + i * H1 != dt.datetime(2024, 3, 31, 3)]
    df = ts(spark.createDataFrame([("a", str(t), 1.0) for t in local], "entity string, ts string, y double"), "ts")
    st = spark.createDataFrame([("a", 50.0, 30.0)], "entity string, latitude double, longitude double")
    opt = B.BuildOptions(zone="Europe/Kyiv", min_rows=1, min_days=1)
    got = B.build_silver(B.Sources(df, st), opt).cache()
    assert got.count() == 71 and G.missing_counts(got).first().missing_count == 0
    assert got.filter("latitude is null or y is null").count() == 0


def test_dated_facts_follow_the_local_day(spark):
    local = hours(spark, [(i, 1.0) for i in range(72)], start=dt.datetime(2024, 6, 1))
    st = spark.createDataFrame([("a", 50.0, 30.0)], "entity string, latitude double, longitude double")
    inst = ts(spark.createDataFrame([("a", "2024-06-01 00:00:00", 7.0)], "entity string, since string, power double"),
              "since")
    rules = K.rules_frame(spark, {"a": "2024-06-02"}, {})
    opt = B.BuildOptions(zone="Europe/Kyiv", min_rows=1, min_days=0)
    src = B.Sources(local, st, solar=inst, chargers=inst, rules=rules)
    got = B.surround(B.describe(B.conform(src, opt), src, opt), src, opt).orderBy("ts").collect()
    # The local day of 2 June starts at 21:00 UTC of the day before.
    assert str(got[0].ts) == "2024-06-01 21:00:00" and len(got) == 48
    assert {r.max_solar for r in got} == {7.0} and {r.max_ev for r in got} == {7.0}


def test_pick_orders(spark):
    c = spark.createDataFrame([("c", i, float(i), float(10 - i)) for i in range(8)],
                              "cluster string, order_id int, aic double, val_money_pct double")
    assert V.pick_orders(c, "cluster", 5).first().order_id == 4


def test_published_tables(spark):
    rules = K.published_rules(spark)
    assert rules.count() == 11 and rules.filter("since is not null").count() == 10
    coords = K.published_coordinates(spark)
    assert coords.count() == 21
    assert coords.filter("latitude between 48 and 51 and longitude between 22 and 32").count() == 21


def test_nan_is_unknown(spark):
    df = spark.createDataFrame([("a", float("nan")), ("b", 1.0), ("c", None)], "k string, v double")
    assert [r.v for r in K.nan_to_null(df).orderBy("k").collect()] == [None, 1.0, None]
