"""Weeks, days and instants, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO, US = "iso", "us"

_DAY_MICROS = 86_400_000_000


def week_monday(day: Column, week_start: str = ISO) -> Column:
    """The Monday of the week of ``day`` (a date or wall-clock timestamp).

    ``iso`` weeks run from Monday. ``us`` weeks run from Sunday, so that a Sunday belongs to the
    Monday after it.
    """
    day = day.cast("date")
    if week_start == ISO:
        return F.trunc(day, "week")
    if week_start == US:
        return F.trunc(F.date_add(day, 1), "week")
    raise ValueError(f"week_start must be {ISO!r} or {US!r}, not {week_start!r}")


def week_window(instant: Column, week_start: str = ISO) -> Column:
    """The same week as an event-time window, for streams whose closed weeks are dropped."""
    # Windows are counted from 1970-01-01, a Thursday.
    first_day = {ISO: "4 days", US: "3 days"}[week_start]
    return F.window(instant, "7 days", "7 days", first_day)


def window_monday(window: Column, week_start: str = ISO) -> Column:
    """The ``week_monday`` that labels a ``week_window``."""
    first = wall_clock(window["start"]).cast("date")
    return F.date_add(first, 1) if week_start == US else first


# Casts between wall-clock time and instants, and intervals of a day or more, follow the session
# time zone. Day numbers and intervals below a day do not.
def instant(wall: Column) -> Column:
    """A date or wall-clock timestamp as the UTC instant, which watermarks need."""
    day = wall.cast("date")
    midnight = F.timestamp_seconds(F.unix_date(day).cast("long") * 86400)
    return midnight + (wall.cast("timestamp_ntz") - day.cast("timestamp_ntz"))


def wall_clock(instant_: Column) -> Column:
    """An instant as UTC wall-clock time; the inverse of ``instant``."""
    micros = F.unix_micros(instant_)
    rest = F.pmod(micros, F.lit(_DAY_MICROS))
    day = F.date_from_unix_date(((micros - rest) / _DAY_MICROS).cast("int"))
    seconds = (rest.cast("decimal(18,0)") / 1_000_000).cast("decimal(18,6)")
    return day.cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
