"""Streams keep keyed state: repeats are dropped, replays leave one copy, earlier batches are not read."""

import pytest
from pyspark.sql import functions as F

from gridspan.plans.lineage import new_path
from gridspan.streaming import enrich, progressive


def landed_files(spark, frames):
    path = new_path(spark, "landed")
    for i, f in enumerate(frames):
        f.coalesce(1).write.parquet(f"{path}/p{i}")
    return path


def one_file_a_batch(spark, path, schema):
    return (spark.readStream.schema(schema).option("recursiveFileLookup", "true")
            .option("maxFilesPerTrigger", 1).parquet(path))


def test_repeats_of_a_batch_are_enriched_once(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (2, "c")], "id int, v string")
    again = spark.createDataFrame([(None, "b"), (2, "c"), (3, "d")], "id int, v string")
    path = landed_files(spark, [rows, again, rows])
    seen, out, mark = [], new_path(spark, "rich"), new_path(spark, "mark")

    def rich(b):
        seen.append(b.count())
        return b.withColumn("w", F.upper("v"))
    assert enrich.enrich_available(one_file_a_batch(spark, path, rows.schema), ["id"], rich, out, mark)
    got = sorted((r.id or 0, r.v, r.w) for r in spark.read.parquet(out).collect())
    assert got == [(0, "b", "B"), (1, "a", "A"), (2, "c", "C"), (3, "d", "D")]
    assert sum(seen) == 4


def test_a_failed_batch_is_done_again(spark):
    rows = [spark.range(i * 3, i * 3 + 5).coalesce(1) for i in range(3)]
    path = landed_files(spark, rows)
    out, mark, broken = new_path(spark, "rich"), new_path(spark, "mark"), [True]

    def rich(b):
        if broken and b.filter("id = 7").count():
            broken.clear()
            raise ValueError("source is away")
        return b
    stream = lambda: one_file_a_batch(spark, path, "id long")
    with pytest.raises(Exception, match="source is away"):
        enrich.enrich_available(stream(), ["id"], rich, out, mark)
    assert enrich.enrich_available(stream(), ["id"], rich, out, mark)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(11))


def test_earlier_output_is_not_read(spark):
    """Output of earlier batches may be moved away: which keys are done is the stream's own state."""
    path = landed_files(spark, [spark.range(4)])
    first, second, mark = new_path(spark, "first"), new_path(spark, "second"), new_path(spark, "mark")
    stream = lambda: one_file_a_batch(spark, path, "id long")
    assert enrich.enrich_available(stream(), ["id"], lambda b: b, first, mark)
    spark.range(6).coalesce(1).write.parquet(f"{path}/more")
    assert enrich.enrich_available(stream(), ["id"], lambda b: b, second, mark)
    assert sorted(r.id for r in spark.read.parquet(second).collect()) == [4, 5]


def test_progressive_state_is_one_row_a_batch_and_repeats_do_not_count(spark):
    days = [spark.range(24).select(F.lit("a").alias("entity"), F.expr(
        f"timestamp_ntz'2024-01-01' + make_dt_interval({i}, cast(id as int))").alias("ts"),
        (F.col("id") + 0.0).alias("x"), (2.0 * F.col("id") + 1).alias("y")) for i in range(3)]
    path = landed_files(spark, [days[0], days[1].unionByName(days[1]), days[2].unionByName(days[0])])
    state, out, mark = (new_path(spark, s) for s in ("state", "preds", "mark"))
    progressive.progressive_stream(one_file_a_batch(spark, path, days[0].schema), ["x"], state, out, mark)
    totals = {r.batch: r.gram for r in spark.read.parquet(state).collect()}
    assert sorted(totals) == [0, 1, 2] and sorted(g[0] for g in totals.values()) == [24.0, 48.0, 72.0]
    got = spark.read.parquet(out)
    assert got.count() == 72
    learned = got.filter("batch > 0").select((F.abs(F.col("pred") - F.col("y"))).alias("e")).agg(F.max("e")).first()[0]
    assert learned < 0.1 and got.filter("batch = 0 and pred != 0").count() == 0
