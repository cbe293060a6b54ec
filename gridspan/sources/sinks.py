"""Tables written by a build: stages, gold layouts, results, metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.encode import categories, one_hot

# Categoricals that the second gold layout spreads to 0/1 columns.
ONE_HOT_COLUMNS = ("dso_desc", "station_type", "oblast", "Month", "Day", "Hour", "day_of_week",
                   "season")


def write_stage(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a stage and go on from its files (plans stay short, lost work is re-read)."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def write_gold(df: DataFrame, folder: str, split: str = "data_subset",
               ts: str = "datetime", hot: Sequence[str] = ONE_HOT_COLUMNS) -> dict[str, str]:
    """Both gold layouts, each partitioned by split: categoricals as text with the timestamp,
    and 0/1 columns without it."""
    text, wide = f"{folder}/datetime_time_idx_global_cat", f"{folder}/time_idx_ohe"
    df.write.mode("overwrite").partitionBy(split).parquet(text)
    present = [c for c in hot if c in df.columns]
    spread = one_hot(df, categories(df, *present)) if present else df
    spread.drop(ts).write.mode("overwrite").partitionBy(split).parquet(wide)
    return {"text": text, "one_hot": wide}


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_predictions(df: DataFrame, path: str, split: str | None = None) -> str:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(split) if split else writer).parquet(path)
    return path


def metric_rows(scores: DataFrame, run: str, keys: Sequence[str] = ()) -> DataFrame:
    """Score table to long form: run, keys, metric, value."""
    names = [c for c in scores.columns if c not in keys]
    return scores.select(F.lit(run).alias("run"), *keys, F.explode(F.map_from_arrays(
        F.array(*map(F.lit, names)),
        F.array(*[F.col(c).cast("double") for c in names]))).alias("metric", "value"))


def log_metrics(scores: DataFrame, path: str, run: str, keys: Sequence[str] = ()) -> None:
    metric_rows(scores, run, keys).write.mode("append").parquet(path)
