"""Landed meter readings and panel tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import from_date_and_hour
from ..operators.clean import drop_labels, nan_to_null, project
from ..spec import PANEL, TOTAL_LABELS, PanelSpec, require_columns


def read_sheets(spark: SparkSession, paths: str | Sequence[str], columns: Mapping[str, str],
                types: Mapping[str, str], dated: str = "date",
                encoding: str = "UTF-8") -> DataFrame:
    """Landed sheets as CSV files, all files in one scan, one explicit layout.

    ``columns`` maps landed to canonical names in file order; ``types`` gives the SQL type of
    the canonical columns that are not text.  Report heads and header lines are recognised by
    content, not by position, so files stay splittable: a data line has a value under
    ``dated`` and its typed columns either empty or readable.
    """
    named, bad = _sheet_lines(spark, paths, columns, types, dated, encoding)
    return named.filter(F.col(dated).isNotNull() & (F.size(bad) == 0)).select(*[
        F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in named.columns])


def _sheet_lines(spark, paths, columns, types, dated, encoding) -> tuple[DataFrame, Column]:
    """All lines as text under canonical names, and the typed columns a line has an unreadable value in."""
    layout = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    raw = spark.read.schema(layout).options(header="false", mode="PERMISSIVE",
                                            encoding=encoding).csv(paths)
    unreadable = [F.when(F.col(c).isNotNull() & F.col(c).try_cast(kind).isNull(), F.lit(c)) for c, kind in types.items()]
    return project(raw, columns), F.array_compact(F.array(*unreadable).cast("array<string>"))


def rejected_lines(spark: SparkSession, paths: str | Sequence[str], columns: Mapping[str, str],
                   types: Mapping[str, str], dated: str = "date", encoding: str = "UTF-8") -> DataFrame:
    """What :func:`read_sheets` leaves out although it is data: (line, reasons, n), once per different line.

    ``line`` is the row as JSON text, ``reasons`` names each typed column with an unreadable value.  A header
    (a line with a column's own landed name under it) and a line without ``dated`` are no data.
    """
    named, bad = _sheet_lines(spark, paths, columns, types, dated, encoding)
    header = reduce(lambda a, b: a | b, [F.col(c).eqNullSafe(F.lit(landed)) for landed, c in columns.items()])
    reasons = F.transform(bad, lambda c: F.concat(c, F.lit(" is unreadable")))
    lines = named.filter(F.col(dated).isNotNull() & (F.size(bad) > 0) & ~header).select(
        F.to_json(F.struct("*")).alias("line"), F.array_join(reasons, ", ").alias("reasons"))
    return lines.groupBy("line", "reasons").agg(F.count("*").alias("n"))


def read_parts(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Parquet parts whose columns differ; absent columns are NULL."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def conform_readings(raw: DataFrame, entity: str = "entity", date: str = "date",
                     hour: str = "hour", value: str = "y", labels: Sequence[str] = TOTAL_LABELS,
                     spec: PanelSpec = PANEL) -> DataFrame:
    """Raw readings to (entity, ts, y): total rows dropped, date and hour put together."""
    require_columns(raw, [entity, date, hour, value])
    kept = drop_labels(raw, entity, labels)
    rest = [c for c in raw.columns if c not in (entity, date, hour, value)]
    return nan_to_null(kept.select(kept[entity].alias(spec.entity),
                                   from_date_and_hour(date, hour).alias(spec.ts),
                                   kept[value].alias(spec.y), *rest))


def read_panel(spark: SparkSession, path: str, spec: PanelSpec = PANEL,
               columns: Sequence[str] | None = None, partitions: int | None = None) -> DataFrame:
    """A gold table; column and row filters of the caller reach the scan.

    With ``partitions`` rows are range-placed and sorted by (entity, index); a hot entity is
    split over several partitions.
    """
    df = spark.read.parquet(path)
    if columns:
        df = require_columns(df, columns).select(*columns)
    if partitions:
        order = spec.idx if spec.idx in df.columns else spec.ts
        df = df.repartitionByRange(partitions, spec.entity, order).sortWithinPartitions(
            spec.entity, order)
    return df
