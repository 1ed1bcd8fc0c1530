"""Calendar bins and their labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SCALES = ("daily", "weekly", "monthly", "annual", "seasonal")


def calendar_bin(time: Column, scale: str) -> Column:
    """Label (a date) of the bin that holds `time`.

    Weeks run Monday to Sunday and carry the Sunday; months and years carry their
    last day; seasons (DJF, MAM, JJA, SON) carry their first day."""
    day = time.cast("date")
    if scale == "daily":
        return day
    if scale == "weekly":
        return F.date_add(F.trunc(day, "week"), 6)
    if scale == "monthly":
        return F.last_day(day)
    if scale == "annual":
        return F.make_date(F.year(day), F.lit(12), F.lit(31))
    if scale == "seasonal":
        return F.add_months(F.trunc(F.add_months(day, 1), "quarter"), -1)
    raise ValueError(f"scale must be one of {', '.join(SCALES)}, not {scale!r}")


def is_leap_day(time: Column) -> Column:
    return (F.month(time) == 2) & (F.day(time) == 29)
