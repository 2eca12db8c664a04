"""Date parts that the dialect has and Spark spells differently."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DAYS = ["SUNDAY", "MONDAY", "TUESDAY", "WEDNESDAY", "THURSDAY", "FRIDAY", "SATURDAY"]


def week(day: Column, begins: str = "SUNDAY") -> Column:
    """EXTRACT(WEEK(begins) FROM day): weeks begin on that day of the week; days before the year's first are in week 0."""
    since = F.pmod(F.dayofweek(day) - 1 - F.lit(DAYS.index(begins)), F.lit(7))
    return F.floor((F.dayofyear(day) - 1 - since + 7) / 7).cast("int")


def trunc_week(day: Column, begins: str = "SUNDAY") -> Column:
    """DATE_TRUNC(day, WEEK(begins))."""
    return F.date_sub(day, F.pmod(F.dayofweek(day) - 1 - F.lit(DAYS.index(begins)), F.lit(7)))


def at_zone(ts: Column, zone: str) -> Column:
    """The wall clock of ``zone``: EXTRACT(part FROM ts AT TIME ZONE zone) is that part of it; ts in UTC."""
    return F.from_utc_timestamp(ts, zone)
