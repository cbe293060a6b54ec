"""Resumable enrichment: every key is enriched once, whatever is interrupted or replayed."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame

from .state import first_of_keys, state_on_disk


def enrich_available(stream: DataFrame, keys: Sequence[str], enrich: Callable[[DataFrame], DataFrame],
                     output: str, checkpoint: str, stop: Callable[[], bool] = lambda: False) -> bool:
    """Enrich one row of every key, batch by batch; True when all that was available is done.

    ``enrich`` sees a row of each key that is new; use keys as fine as the rows (entity and time for a
    panel) where later rows of an entity must not be skipped.  The keys seen are the stream's own state:
    a batch looks up its keys, earlier output is not read again.  Each batch owns the directory
    ``batch=<id>`` and overwrites it, so a replayed batch leaves one copy; ``output`` and ``checkpoint``
    belong together.  Where ``stop`` turns true the run ends before the next batch and returns False;
    the next run goes on with that batch.
    """
    halted = []

    def one(batch: DataFrame, number: int) -> None:
        if stop():
            halted.append(number)
            raise _Halt(f"stopped before batch {number}")
        enrich(batch).write.mode("overwrite").parquet(f"{output}/batch={number}")

    with state_on_disk(stream.sparkSession):
        query = (first_of_keys(stream, keys).writeStream.foreachBatch(one)
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        try:
            query.awaitTermination()
        except StreamingQueryException:
            if not halted:
                raise
    return not halted


class _Halt(RuntimeError):
    """Leaves a batch uncommitted, so that the next run starts with it."""
