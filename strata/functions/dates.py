"""Dates, epoch milliseconds and calendar periods."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Calendar unit -> interval literal that leads to the next period.
PERIOD_STEP = {
    "day": "INTERVAL 1 DAY",
    "week": "INTERVAL 7 DAY",
    "month": "INTERVAL 1 MONTH",
    "quarter": "INTERVAL 3 MONTH",
    "year": "INTERVAL 1 YEAR",
}


def parse_date(column: Column, pattern: str = "yyyy-MM-dd", strict: bool = False) -> Column:
    """Text to date. Text that is no date gives null, or raises when strict under ANSI mode."""
    return F.to_date(column, pattern) if strict else F.try_to_date(column, pattern)


def from_epoch_millis(column: Column) -> Column:
    """Epoch milliseconds to a timestamp, in integer arithmetic."""
    return F.timestamp_millis(column)


def _step(unit: str) -> Column:
    if unit not in PERIOD_STEP:
        raise ValueError(f"unknown period {unit!r}; use one of {sorted(PERIOD_STEP)}")
    return F.expr(PERIOD_STEP[unit])


def period_of(column: Column, unit: str = "month") -> Column:
    """First day of the period that ``column`` falls in."""
    _step(unit)
    day = column.cast("date")
    return day if unit == "day" else F.trunc(day, unit)


def previous_period(column: Column, unit: str = "month") -> Column:
    return (column - _step(unit)).cast("date")


def next_period(column: Column, unit: str = "month") -> Column:
    return (column + _step(unit)).cast("date")


def periods_between(first: Column, last: Column, unit: str = "month") -> Column:
    """Array of the period starts from ``first`` to ``last``; empty when ``last`` is earlier."""
    return F.when(first <= last, F.sequence(first, last, _step(unit))).otherwise(
        F.array().cast("array<date>")
    )


# The same for single dates on the driver, without a job.


def start_of(day: dt.date, unit: str = "month") -> dt.date:
    """First day of the period that ``day`` falls in."""
    _step(unit)
    day = day.date() if isinstance(day, dt.datetime) else day
    if unit == "day":
        return day
    if unit == "week":
        return day - dt.timedelta(days=day.weekday())
    months = {"month": 1, "quarter": 3, "year": 12}[unit]
    return dt.date(day.year, (day.month - 1) // months * months + 1, 1)


def start_after(start: dt.date, unit: str = "month") -> dt.date:
    """The period start after ``start``."""
    if unit in ("day", "week"):
        return start + dt.timedelta(days={"day": 1, "week": 7}[unit])
    # Beyond the longest period, back to its first day.
    days = {"month": 32, "quarter": 93, "year": 367}[unit]
    return start_of(start + dt.timedelta(days=days), unit)


def starts_between(first: dt.date, last: dt.date, unit: str = "month") -> list[dt.date]:
    """The period starts from ``first`` to ``last``."""
    found = []
    while first <= last:
        found.append(first)
        first = start_after(first, unit)
    return found
