"""Dense integer codes for sorted distinct values, without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .lineage import cut


def dense_codes(df: DataFrame, column: str, code: str = "code", start: int = 0) -> DataFrame:
    """Distinct non-null values of ``column`` numbered in ascending order from ``start``.

    Values are range-partitioned and materialised once, so partition numbers are stable;
    the offset of a partition is the sum of the sizes of the partitions before it (one row
    per partition).
    """
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    ranged = cut(values.repartitionByRange(F.col(column)).withColumn("_p", F.spark_partition_id()))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy("_p").count()
               .select("_p", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_off")))
    inside = Window.partitionBy("_p").orderBy(column)
    return (ranged.withColumn("_r", F.row_number().over(inside) - 1)
            .join(offsets, "_p")
            .select(column, (F.col("_r") + F.col("_off") + start).cast("long").alias(code)))
