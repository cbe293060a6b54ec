"""Local clock time to instants with explicit daylight-saving policies.

Wall times are NTZ; sessions show instants in UTC (``build_session``, ``pin_utc``), so that
casts between NTZ and instants do not move them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AMBIGUOUS = ("earliest", "latest", "null", "raise")
NONEXISTENT = ("shift_forward", "null", "raise")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _utc(local: Column, zone: str) -> Column:
    return F.to_utc_timestamp(local.cast("timestamp"), zone).cast("timestamp_ntz")


def _local(utc: Column, zone: str) -> Column:
    return F.from_utc_timestamp(utc.cast("timestamp"), zone).cast("timestamp_ntz")


def to_local(utc: str | Column, zone: str) -> Column:
    """UTC wall time (NTZ) to local wall time."""
    return _local(_col(utc).cast("timestamp_ntz"), zone)


def to_utc(local: str | Column, zone: str, ambiguous: str = "earliest",
           nonexistent: str = "shift_forward") -> Column:
    """Local wall time (NTZ) to UTC wall time.

    A stamp is *ambiguous* when the clock shows it twice and *non-existent* when the clock
    skips it.  ``shift_forward`` moves a skipped stamp to the first instant after the jump.
    """
    if ambiguous not in AMBIGUOUS or nonexistent not in NONEXISTENT:
        raise ValueError(f"unknown policy {ambiguous!r}/{nonexistent!r}")
    local = _col(local).cast("timestamp_ntz")
    hour = F.expr("interval 1 hour")
    first = _utc(local, zone)
    skipped = _local(first, zone) != local
    # The overlap can be reported at either of its instants, so look both ways.
    earlier = _local(first - hour, zone) == local
    later = _local(first + hour, zone) == local
    early = F.when(earlier, first - hour).otherwise(first)
    late = F.when(later, first + hour).otherwise(first)
    twice = earlier | later

    def stop(what: str) -> Column:
        return F.raise_error(F.concat(F.lit(f"{what} local time "), local.cast("string"))).cast(
            "timestamp_ntz")

    two = {"earliest": early, "latest": late,
           "null": F.lit(None).cast("timestamp_ntz"), "raise": stop("ambiguous")}[ambiguous]
    # The gap is one hour: the first instant after it is the top of that hour.
    none = {"shift_forward": F.date_trunc("hour", first),
            "null": F.lit(None).cast("timestamp_ntz"),
            "raise": stop("non-existent")}[nonexistent]
    return F.when(local.isNull(), None).when(skipped, none).when(twice, two).otherwise(first)


def floor_hour(ts: str | Column) -> Column:
    return F.date_trunc("hour", _col(ts))
