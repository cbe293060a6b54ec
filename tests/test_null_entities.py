"""An unknown entity is an entity: carried state does not depend on how time is cut into slabs."""

import pytest
from pyspark.sql import functions as F

from gridspan.operators import clean as K
from gridspan.operators import features as L
from gridspan.operators import grid as G
from gridspan.operators import joins as J
from gridspan.spec import PANEL


def panel(spark, whole=False):
    rows = [(e, i, None if i % 4 else float(i + k)) for k, e in enumerate(("a", None)) for i in range(60) if whole or i % 17]
    df = spark.createDataFrame(rows, "entity string, time_idx long, y double")
    return df.withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("time_idx").cast("int")))


@pytest.mark.parametrize("size", [3, 7, 20])
def test_state_of_a_null_entity_is_carried(spark, size):
    df = panel(spark)
    works = {"interpolate": lambda n: G.interpolate(df, ["y"], PANEL, size=n),
             "fill": lambda n: G.fill_both_ways(df, ["y"], PANEL, {}, n), "trim": lambda n: G.trim_to_tail(df, PANEL, 0, 0, n),
             "decompose": lambda n: L.decompose(panel(spark, True).fillna(0.0, ["y"]), PANEL, 4, n)}
    for name, work in works.items():
        rows = lambda n: sorted((tuple(r) for r in work(n).collect()), key=str)
        whole = rows(10_000)
        assert rows(size) == whole and any(r[0] is None for r in whole), name


@pytest.mark.parametrize("days", [1, 84])
def test_dated_sums_of_a_null_entity(spark, days):
    adds = spark.createDataFrame([(None, "2024-01-01 05:00:00", 2.0), (None, "2024-01-02 01:00:00", 3.0)],
                                 "entity string, since string, power double").withColumn("since", F.col("since").cast("timestamp_ntz"))
    got = J.effective_sum(panel(spark), adds, "since", "power", slab_days=days).filter("entity IS NULL").collect()
    assert all(r.max_ev == (0.0 if r.time_idx < 5 else 2.0 if r.time_idx < 25 else 5.0) for r in got) and len(got) == 56


def test_no_join_gathers_an_entity(spark):
    """With broadcasts off, the exchange of rows under every join is on entity and slab."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = spark.range(20_000).select(F.lit("hot").alias("entity"), F.col("id").alias("time_idx"), F.col("id").cast("double").alias("y"),
                                          F.timestamp_seconds("id").cast("timestamp_ntz").alias("ts"))
        df = rows.withColumn("max_power", F.lit(None).cast("double"))
        for out in (G.trim_to_tail(df, PANEL, size=500), K.fill_by_group_max(df, "max_power", PANEL.with_(step_seconds=1), size=500),
                    L.decompose(df.select("entity", "ts", "time_idx", "y"), size=500), L.position_covariates(df, 10, size=500)):
            sizes = out.groupBy(F.spark_partition_id()).count().collect()
            assert len(sizes) >= 4 and max(r["count"] for r in sizes) < 0.6 * 20_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
