"""Nested JSON payloads: hourly arrays, alarms, name dictionaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def hourly_schema(variables: Sequence[str]) -> T.StructType:
    fields = [T.StructField("time", T.ArrayType(T.StringType()))]
    fields += [T.StructField(v, T.ArrayType(T.DoubleType())) for v in variables]
    return T.StructType([T.StructField("hourly", T.StructType(fields))])


def hourly_rows(df: DataFrame, payload: str, variables: Sequence[str], ts: str = "ts") -> DataFrame:
    """Parallel hourly arrays to rows: short arrays are padded with NULL, long ones cut to
    the number of times, absent variables NULL."""
    rest = [c for c in df.columns if c != payload]
    parsed = df.select(*rest, F.from_json(payload, hourly_schema(variables)).alias("_p"))
    times = F.col("_p.hourly.time")
    rows = parsed.filter(times.isNotNull()).select(*rest, F.posexplode(times).alias("_i", "_t"), "_p")
    stamp = F.try_to_timestamp("_t").cast("timestamp_ntz")
    return rows.select(*rest, stamp.alias(ts), *[
        F.get(F.col(f"_p.hourly.{v}"), F.col("_i")).alias(v) for v in variables]
    ).filter(F.col(ts).isNotNull())


ALARM = T.StructType([
    T.StructField("regionId", T.StringType()), T.StructField("startDate", T.StringType()),
    T.StructField("endDate", T.StringType()), T.StructField("duration", T.StringType()),
    T.StructField("alertType", T.StringType()), T.StructField("regionName", T.StringType()),
    T.StructField("isContinue", T.BooleanType()),
])
ALARMS = T.ArrayType(T.StructType([
    T.StructField("regionId", T.StringType()), T.StructField("regionName", T.StringType()),
    T.StructField("alarms", T.ArrayType(ALARM)),
]))


def alarm_rows(df: DataFrame, payload: str) -> DataFrame:
    """One row per alarm; a region without alarms keeps one row with NULLs."""
    rest = [c for c in df.columns if c != payload]
    regions = df.select(*rest, F.explode(F.from_json(payload, ALARMS)).alias("_r"))
    alarms = regions.select(*rest, F.col("_r.regionId").alias("region_id"),
                            F.col("_r.regionName").alias("region_name"),
                            F.explode_outer("_r.alarms").alias("_a"))
    stamp = lambda c: F.try_to_timestamp(F.col(f"_a.{c}")).cast("timestamp_ntz")
    return alarms.select(*rest, "region_id", "region_name", stamp("startDate").alias("start"),
                         stamp("endDate").alias("end"), F.col("_a.alertType").alias("alert_type"),
                         F.col("_a.isContinue").alias("is_continue"))


def name_ids(df: DataFrame, payload: str, array: str = "states", name: str = "regionName",
             ident: str = "regionId", suffix: str = " область",
             special: dict[str, str] | None = None) -> DataFrame:
    """JSON dictionary to (name, id): names without suffix; ``special`` adds aliases, the id
    of an alias being the first entry whose name contains the given text."""
    schema = T.StructType([T.StructField(array, T.ArrayType(T.StructType([
        T.StructField(ident, T.StringType()), T.StructField(name, T.StringType())])))])
    rows = df.select(F.posexplode(F.from_json(payload, schema)[array]).alias("_i", "_s")).select(
        "_i", F.col(f"_s.{name}").alias("_raw"), F.col(f"_s.{ident}").alias("region_id"))
    out = rows.select(F.trim(F.replace("_raw", F.lit(suffix), F.lit(""))).alias("region_name"),
                      "region_id")
    for alias, part in (special or {}).items():
        first = rows.filter(F.col("_raw").contains(part)).agg(F.min_by("region_id", "_i").alias("region_id"))
        out = out.filter(F.col("region_name") != alias).unionByName(
            first.select(F.lit(alias).alias("region_name"), "region_id"))
    return out


def attach_ids(df: DataFrame, ids: DataFrame, name: str = "region_name",
               unknown: Column | None = None) -> DataFrame:
    """Left join of names to ids with an optional value for unknown names."""
    out = df.join(ids, name, "left")
    return out if unknown is None else out.withColumn("region_id", F.coalesce("region_id", unknown))
