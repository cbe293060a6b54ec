"""Cutting long lineages so that a lost executor replays little work."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Read from ``spark.checkpoint.dir``.  Only a local-mode session without the setting gets a
    temporary folder; on a cluster the absence is an error.
    """
    folder = spark.conf.get(_CONF, None) or spark.sparkContext.getConf().get(_CONF)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_CONF} to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="gridspan-")
    spark.conf.set(_CONF, folder)
    return folder


def new_path(spark: SparkSession, label: str) -> str:
    """A path not used before, for a table written between stages."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and continue from the files."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def staged(df: DataFrame, label: str, partition: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back, which cuts the lineage."""
    path = new_path(df.sparkSession, label)
    writer = df.write.partitionBy(partition) if partition else df.write
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)
