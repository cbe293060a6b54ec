"""Keyed state of streams: which keys were seen, kept by the stream's own checkpoint."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def first_of_keys(stream: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row of every key, in the batch and over all batches; NULL is a key like any other.

    Which of several rows of one batch stays is open.  A batch looks up its own keys only, so its
    cost does not grow with the number of batches before.
    """
    return stream.dropDuplicates(list(keys))


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state on executor disks and in their checkpoint, not on the heap."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)
