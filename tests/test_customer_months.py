"""A small file whose rows become many is spread over tasks first."""

import datetime

from pyspark.sql import functions as F

from gridspan.catalog import fixtures as X

DAY = datetime.datetime(2024, 1, 1)


def test_customers_are_spread_before_they_become_months(spark, tmp_path):
    spark.createDataFrame([(i,) for i in range(40)], "c_custkey long").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(1, DAY), (2, DAY + datetime.timedelta(days=200))], "o_custkey long, o_orderdate timestamp_ntz").write.parquet(
        f"{tmp_path}/orders.parquet")
    months = X.customer_months(spark, str(tmp_path))
    assert months.count() == 40 * 7
    assert months.select(F.spark_partition_id()).distinct().count() > 1
