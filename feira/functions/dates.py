"""Calendar expressions of the date dimension and the smart date keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# National holidays with a fixed month and day.
FIXED_HOLIDAYS = ("01-01", "04-21", "05-01", "09-07", "10-12", "11-02", "11-15", "12-25")


def date_key(col: Column | str) -> Column:
    """yyyyMMdd as an int, from date parts (no text formatting per row)."""
    return F.year(col) * 10000 + F.month(col) * 100 + F.dayofmonth(col)


def date_of_key(col: Column | str) -> Column:
    key = F.col(col) if isinstance(col, str) else col
    return F.make_date(
        (key / 10000).cast("int"), ((key % 10000) / 100).cast("int"), (key % 100).cast("int")
    )


def month_of_key(col: Column | str) -> Column:
    """yyyyMM of a yyyyMMdd key."""
    key = F.col(col) if isinstance(col, str) else col
    return F.floor(key / 100).cast("int")


def is_fixed_holiday(col: Column | str, holidays: tuple[str, ...] = FIXED_HOLIDAYS) -> Column:
    return F.date_format(col, "MM-dd").isin(*holidays)


def hours_between(start: Column | str, end: Column | str) -> Column:
    return F.round((F.unix_timestamp(end) - F.unix_timestamp(start)) / 3600, 2)


def whole_days_between(start: Column | str, end: Column | str) -> Column:
    """Elapsed days rounded half away from zero."""
    return F.round((F.unix_timestamp(end) - F.unix_timestamp(start)) / 86400, 0).cast("int")
