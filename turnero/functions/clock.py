"""Clock and calendar expressions.

Every operator takes ``as_of``: a string, a ``datetime``, a Column, or None
for the current UTC instant.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from turnero.sources.schemas import DIAS_SEMANA

Instant = str | dt.datetime | Column | None


def instant(as_of: Instant = None) -> Column:
    """``as_of`` as a UTC wall-clock timestamp; literals fold and push down."""
    if as_of is None:
        return F.expr("convert_timezone(current_timezone(), 'UTC', localtimestamp())")
    if isinstance(as_of, Column):
        return as_of.cast("timestamp_ntz")
    return F.lit(str(as_of)).cast("timestamp_ntz")


def day(as_of: Instant | dt.date = None) -> Column:
    if isinstance(as_of, dt.date) and not isinstance(as_of, dt.datetime):
        return F.lit(as_of)
    return instant(as_of).cast("date")


def shifted(moment: Column, **units: float) -> Column:
    """``moment`` moved by days/hours/mins/secs."""
    return moment + F.make_dt_interval(*(F.lit(units.get(u, 0)) for u in ("days", "hours", "mins", "secs")))


def plus_minutes(moment: Column, minutes: Column) -> Column:
    return moment + F.make_dt_interval(F.lit(0), F.lit(0), minutes.cast("int"))


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end)


def minutes_between(start: Column, end: Column) -> Column:
    """Fractional minutes between two instants."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(60_000_000.0)


def minute_of_day(moment: Column, up: bool = False) -> Column:
    """Minute of the day; ``up`` rounds a started minute up (for interval ends)."""
    minute = F.hour(moment) * 60 + F.minute(moment)
    if up:
        whole = moment == F.date_trunc("minute", moment)
        minute = F.when(whole, minute).otherwise(minute + 1)
    return minute.cast("int")


def clock_text(minutes: Column) -> Column:
    """Minutes of the day as HH:MM."""
    hours = F.lpad(F.floor(minutes / 60).cast("string"), 2, "0")
    return F.concat(hours, F.lit(":"), F.lpad((minutes % 60).cast("string"), 2, "0"))


def weekday_name(date: Column) -> Column:
    """Weekday name of a date; Monday first."""
    names = F.array(*(F.lit(d) for d in DIAS_SEMANA))
    return F.element_at(names, F.weekday(date) + 1)


def weekday_rank(name: Column) -> Column:
    """1 for LUNES to 7 for DOMINGO, NULL for anything else."""
    names = F.array(*(F.lit(d) for d in DIAS_SEMANA))
    position = F.array_position(names, name)
    return F.when(position > 0, position)
