"""Size checks before a side is copied to every executor."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lineage import cut


def at_most(df: DataFrame, rows: int) -> bool:
    """Whether the frame has at most ``rows`` rows; reads no more than that many and one."""
    return df.limit(rows + 1).count() <= rows


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint when it has at most ``rows`` rows, else unchanged.

    For tables read from files.  Unhinted joins are left to Spark, which broadcasts by its own
    size threshold and otherwise shuffles, with adaptive execution splitting skewed keys.
    """
    return F.broadcast(df) if at_most(df, rows) else df


def small_result(df: DataFrame, rows: int) -> DataFrame:
    """The same for a side derived from large data, such as statistics per entity.

    Its static size estimate is that of its input, so Spark would shuffle the large side
    before it learns better.  The side is therefore materialised once and then counted.
    """
    return small_side(cut(df), rows)
