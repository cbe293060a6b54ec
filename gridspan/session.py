"""Session settings for fleet-panel jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoint files of frames no longer in use are removed.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Rank filters (last rows of an entity) are cut before the shuffle up to this rank.
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
}


def build_session(app: str = "gridspan", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution on and instants shown in UTC.

    Shuffle partitions are left to the cluster: on a large cluster start high (for example
    three times the cores) and let adaptive execution coalesce.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Make timestamp arithmetic independent of the host clock."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark
