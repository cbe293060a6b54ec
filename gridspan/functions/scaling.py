"""Fitted statistics: global, per entity, and their inverses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def guarded_std(x: Column, ddof: int = 0, guard: str = "one", eps: float = 1e-6) -> Column:
    """Standard deviation with a policy for zero: ``one`` replaces it, ``add`` adds ``eps``."""
    sd = F.stddev_pop(x) if ddof == 0 else F.stddev_samp(x)
    if guard == "add":
        return sd + F.lit(eps)
    if guard == "one":
        return F.when(sd.isNull() | (sd == 0), F.lit(1.0)).otherwise(sd)
    return sd


def fit_global(df: DataFrame, columns: Sequence[str], ddof: int = 0,
               guard: str = "one") -> DataFrame:
    """One row ``<c>_mean``, ``<c>_std`` from the fit frame."""
    return df.agg(*[e for c in columns for e in (
        F.avg(c).alias(f"{c}_mean"), guarded_std(F.col(c), ddof, guard).alias(f"{c}_std"))])


def apply_global(df: DataFrame, stats: DataFrame, columns: Sequence[str],
                 suffix: str = "_z") -> DataFrame:
    """Standardise with a one-row statistics frame (read as one scalar subquery)."""
    fitted = df.select("*", stats.select(F.struct("*").alias("_f")).scalar().alias("_f"))
    return fitted.select(*df.columns, *[
        ((F.col(c) - F.col(f"_f.{c}_mean")) / F.col(f"_f.{c}_std")).alias(f"{c}{suffix}")
        for c in columns])


def fit_by_entity(df: DataFrame, entity: str, y: str, ddof: int = 0, guard: str = "one",
                  eps: float = 1e-6) -> DataFrame:
    return df.groupBy(entity).agg(F.avg(y).alias("mean"),
                                  guarded_std(F.col(y), ddof, guard, eps).alias("std"))


def apply_by_entity(df: DataFrame, stats: DataFrame, fallback: DataFrame, entity: str, y: str,
                    output: str = "y_norm") -> DataFrame:
    """Standardise per entity; entities without statistics use the global row."""
    joined = df.join(stats.select(entity, F.col("mean").alias("_m"), F.col("std").alias("_s")),
                     entity, "left")
    m = F.coalesce("_m", fallback.select(f"{y}_mean").scalar())
    s = F.coalesce("_s", fallback.select(f"{y}_std").scalar())
    return joined.select(*df.columns, m.alias("norm_mean"), s.alias("norm_std"),
                         ((F.col(y) - m) / s).alias(output))


def inverse(value: str, mean: str = "norm_mean", std: str = "norm_std") -> Column:
    return F.col(value) * F.col(std) + F.col(mean)


def softplus(x: str | Column) -> Column:
    """log(1 + e^x) without overflow."""
    x = F.col(x) if isinstance(x, str) else x
    return F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))


def softplus_inverse(z: str | Column) -> Column:
    """x with softplus(x) = z, for z > 0."""
    z = F.col(z) if isinstance(z, str) else z
    return z + F.log(-F.expm1(-z))
