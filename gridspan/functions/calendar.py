"""Calendar fields, seasons, cyclic encodings and forecast-window rules."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Order of weekday and season names (Monday first, winter first).
WEEKDAY_NAMES = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
SEASON_NAMES = ("winter", "spring", "summer", "autumn")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def season_code(ts: str | Column) -> Column:
    """1 winter (Dec-Feb), 2 spring, 3 summer, 4 autumn."""
    return (F.floor(F.month(_col(ts)) % 12 / 3) + 1).cast("int")


def season_name(ts: str | Column) -> Column:
    return F.element_at(F.array(*map(F.lit, SEASON_NAMES)), season_code(ts))


def calendar_fields(ts: str | Column, *, as_text: bool = False,
                    named_season: bool = False) -> dict[str, Column]:
    """Month, Day, Hour, day_of_week (Monday = 0) and season.

    ``as_text`` gives the text categoricals of the gold layout; ``named_season`` switches
    between ``winter`` and the code ``1``.
    """
    ts = _col(ts)
    fields = {
        "Month": F.month(ts), "Day": F.dayofmonth(ts), "Hour": F.hour(ts),
        "day_of_week": F.weekday(ts),
        "season": season_name(ts) if named_season else season_code(ts).cast("string"),
    }
    if as_text:
        fields = {k: v.cast("string") for k, v in fields.items()}
    return fields


def is_weekend(ts: str | Column) -> Column:
    return (F.weekday(_col(ts)) >= 5).cast("tinyint")


def cyclic(value: str | Column, period: float, offset: float = 0) -> tuple[Column, Column]:
    """(sin, cos) of a value on a circle of ``period`` with a fixed ``offset``."""
    angle = (_col(value) - F.lit(offset)) * F.lit(2 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def name_order(value: str | Column, names: tuple[str, ...], start: int = 0,
               unknown: int = -1) -> Column:
    """Position of a name in a fixed order, case and blanks ignored."""
    clean = F.lower(F.trim(_col(value)))
    pos = F.array_position(F.array(*map(F.lit, names)), clean).cast("int")
    return F.when(pos > 0, pos - 1 + start).otherwise(F.lit(unknown))


def hour_index(ts: str | Column, origin: Column, step_seconds: int = 3600) -> Column:
    """Whole steps from ``origin`` to ``ts``."""
    seconds = (_col(ts).cast("timestamp").cast("long")
               - origin.cast("timestamp").cast("long"))
    return F.floor(seconds / F.lit(step_seconds)).cast("long")


def add_steps(ts: Column, steps: Column | int, step_seconds: int = 3600) -> Column:
    """``ts`` moved by a number of steps; keeps the timestamp type."""
    steps = F.lit(steps) if isinstance(steps, int) else steps
    return ts + F.make_dt_interval(secs=steps * F.lit(step_seconds).cast("long"))


def from_parts(year, month, day, hour) -> Column:
    """Timestamp from report columns; NULL when the parts make no date."""
    text = F.format_string("%04d-%02d-%02d", *[_col(c).cast("int") for c in (year, month, day)])
    base = F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("timestamp_ntz")
    return add_steps(base, F.coalesce(_col(hour).cast("long"), F.lit(0)))


def from_date_and_hour(date, hour) -> Column:
    """Date text (coerced to NULL when bad) plus an hour that counts as 0 when absent."""
    base = F.try_to_timestamp(_col(date).cast("string")).cast("timestamp_ntz")
    return add_steps(base, F.coalesce(_col(hour).cast("long"), F.lit(0)))


def next_origin(last: str | Column) -> Column:
    """The first full hour after the last stamp."""
    return F.date_trunc("hour", _col(last) + F.expr("interval 1 hour"))


def next_month_window(last: str | Column) -> tuple[Column, Column]:
    """First and last hour of the calendar month after the last stamp."""
    start = F.add_months(F.trunc(_col(last), "month"), 1)
    first = start.cast("timestamp_ntz")
    return first, F.last_day(start).cast("timestamp_ntz") + F.expr("interval 23 hours")


def whole_final_day(end: str | Column) -> Column:
    """A bare date as the end of a window includes all of that day."""
    end = _col(end)
    midnight = F.date_trunc("day", end)
    return F.when(end == midnight, end + F.expr("interval '23:59' hour to minute")).otherwise(end)
