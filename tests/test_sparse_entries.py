"""Sparse vectors are read by what they store, not by their width."""

import datetime

from pyspark.sql import functions as F

from gridspan.catalog import QUERIES
from gridspan.functions import encode as N

DAY = datetime.datetime(2024, 1, 1)


def test_entries_of_sparse_and_dense_vectors(spark):
    rows = [(0, "a", 0.0), (1, "b", 2.5), (2, "c", None), (3, None, 1.0)]
    df = spark.createDataFrame(rows, "id int, c string, x double")
    for fitted in (df, spark.range(60).select(F.col("id").cast("string").alias("c"), F.lit(1.0).alias("x"))):
        m = N.sparse_one_hot(fitted, ["c"], ["x"])
        size, at, x = N.vector_entries("features")
        got = m.transform(df).select("id", "features", size.alias("n"), at.alias("at"), x.alias("x")).orderBy("id").collect()
        for r in got:
            dense = [0.0] * r.n
            for place, v in zip(r["at"], r["x"], strict=True):
                dense[place] = v
            assert str(dense) == str(r.features.toArray().tolist())


def test_wide_one_hot_makes_no_element_per_place(spark, tmp_path):
    events = [(i, DAY + datetime.timedelta(days=i % 30), i % 40, "ab"[i % 2], None if i % 7 == 0 else float(i % 3)) for i in range(200)]
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double").write.parquet(
        f"{tmp_path}/events.parquet")
    df = QUERIES["f11_sparse_one_hot"](spark, str(tmp_path))
    assert "vector_to_array" not in df._jdf.queryExecution().analyzed().toString().lower()
    fit = [e for e in events if e[1] < datetime.datetime(2024, 1, 16)]
    types, users = sorted({e[3] for e in fit}), sorted({str(e[2]) for e in fit})
    place = lambda v, known: known.index(v) if v in known else len(known)
    got = {r.event_id: r for r in df.collect()}
    for i, _, u, t, v in events:
        r = got[i]
        assert (r.width, r.type_place, r.user_place) == (
            len(types) + len(users) + 3, place(t, types), len(types) + 1 + place(str(u), users))
        assert str(r.last) == str(float("nan") if v is None else v)
