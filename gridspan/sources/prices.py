"""Price reports as they land."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import add_steps, from_parts
from ..functions.encode import to_number
from ..functions.timezone import to_utc
from ..plans.slabs import DEFAULT_SLAB, neighbours


def report_to_hours(lines: DataFrame, file: str, line: str, label: str, columns: Sequence[str],
                    ts: str = "ts", zone: str | None = None, ambiguous: str = "null",
                    size: int = DEFAULT_SLAB) -> DataFrame:
    """Nested report to hourly rows.

    A line whose label is a date opens a day; the lines 1..24 below it are its hours (1 is
    midnight).  Only hour lines with all prices are kept.  With ``zone`` the local stamps
    become UTC and ambiguous ones follow the policy (NULL stamps are dropped).
    """
    marked = lines.withColumn("_day", F.when(
        F.col(label).contains("-"), F.to_date(F.try_to_timestamp(F.substring(label, 1, 10)))))
    near = neighbours(marked, [file], line, ["_day"], size)
    hour = to_number(label)
    start = F.col("_day__prev").cast("timestamp_ntz")
    stamp = add_steps(start, (hour - 1).cast("long"))
    if zone:
        stamp = to_utc(stamp, zone, ambiguous, "shift_forward")
    return (near.filter(hour.isNotNull()).select(stamp.alias(ts), *columns)
            .dropna())


def flat_prices(rows: DataFrame, year: str, month: str, day: str, hour: str, price: str,
                ts: str = "ts", total: str = "Grand Total") -> DataFrame:
    """Flat report (year, month, day, hour, price) to hourly rows without its total row."""
    kept = rows.filter(F.col(year).isNull() | (F.col(year).cast("string") != total))
    numbers = [to_number(c).cast("int") for c in (year, month, day, hour)]
    return kept.select(from_parts(*numbers).alias(ts), F.col(price)).dropna()
