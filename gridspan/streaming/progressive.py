"""Predict-then-learn: a ridge regression that sees a day only after predicting it."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.search import gram_rows, solve, unpack
from ..plans.sizing import small_result
from ..spec import PANEL, PanelSpec
from .state import first_of_keys, state_on_disk


def _dot(columns: Sequence[str], coef: str) -> Column:
    value = F.get(F.col(coef), F.lit(0))
    for i, c in enumerate(columns):
        value = value + F.get(F.col(coef), F.lit(i + 1)) * F.col(c)
    return value


def _coefficients(grams: DataFrame, key: str, width: int, ridge: float) -> DataFrame:
    """Solve each row's normal equations (a small matrix per row)."""
    kind = grams.schema[key].dataType.simpleString()

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            coefs = [solve(unpack(np.asarray(g, dtype=float), width + 2), list(range(width + 1)),
                           ridge)[0].tolist() for g in batch["gram"]]
            yield pd.DataFrame({key: batch[key], "coef": coefs})
    return grams.select(key, "gram").mapInPandas(fit, f"{key} {kind}, coef array<double>")


def predict_then_learn(df: DataFrame, features: Sequence[str], spec: PanelSpec = PANEL,
                       ridge: float = 1e-4) -> DataFrame:
    """Predictions of each day by a model of all strictly earlier days (0 on the first).

    One matrix of sums per day is enough: cumulating them over the days gives every model.
    The cumulative step has one row per day.
    """
    day = F.to_date(spec.ts)
    daily = gram_rows(df.withColumn("day", day), ["day"], features, spec.y)
    size = (len(features) + 2) * (len(features) + 3) // 2
    before = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    sums = daily.select("day", *[F.col("gram")[i].alias(f"_g{i}") for i in range(size)])
    past = sums.select("day", F.array(*[F.sum(f"_g{i}").over(before) for i in range(size)]).alias("gram"))
    coef = _coefficients(past.filter(F.col("gram")[0].isNotNull()), "day", len(features), ridge)
    joined = df.withColumn("day", day).join(small_result(coef, 50_000), "day", "left")
    return joined.select(*df.columns, "day", F.coalesce(_dot(features, "coef"), F.lit(0.0)).alias("pred"))


def progressive_stream(stream: DataFrame, features: Sequence[str], state: str, output: str,
                       checkpoint: str, spec: PanelSpec = PANEL, ridge: float = 1e-4,
                       keys: Sequence[str] | None = None) -> None:
    """The same on a stream, one micro-batch per step: predict it, write the predictions, then
    add its sums to the state.

    A row delivered again is neither predicted nor learned again; rows are told apart by ``keys``
    (entity and time by default).  Batch n reads the total that batch n - 1 wrote, one row, and writes its
    own.  Replayed batches overwrite their own files; ``state``, ``output`` and ``checkpoint`` belong together.
    """
    size = (len(features) + 2) * (len(features) + 3) // 2

    def one(batch: DataFrame, number: int) -> None:
        spark: SparkSession = batch.sparkSession
        keyed = batch.withColumn("k", F.lit(0))
        total = gram_rows(keyed, ["k"], features, spec.y).select("k", "gram")
        coef = spark.createDataFrame([], "k int, coef array<double>")
        if number > 0:
            before = spark.read.schema("k int, gram array<double>").parquet(f"{state}/batch={number - 1}")
            coef = _coefficients(before, "k", len(features), ridge)
            total = total.unionByName(before)
        pred = F.coalesce(_dot(features, "coef"), F.lit(0.0)).alias("pred")
        # One row of coefficients.
        keyed.join(F.broadcast(coef), "k", "left").select(*batch.columns, pred).write.mode("overwrite").parquet(
            f"{output}/batch={number}")
        total.groupBy("k").agg(F.array(*[F.sum(F.col("gram")[i]) for i in range(size)]).alias("gram")).write.mode(
            "overwrite").parquet(f"{state}/batch={number}")

    with state_on_disk(stream.sparkSession):
        (first_of_keys(stream, keys or (spec.entity, spec.ts)).writeStream.foreachBatch(one)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())
