"""Calendar helpers for ``yyyy-MM`` months."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTH_PATTERN = r"(\d{4}-\d{2})"


def _index(month: str) -> int:
    if not re.fullmatch(r"\d{4}-(0[1-9]|1[0-2])", month):
        raise ValueError(f"not a yyyy-MM month: {month!r}")
    return int(month[:4]) * 12 + int(month[5:]) - 1


def _month(index: int) -> str:
    return f"{index // 12:04d}-{index % 12 + 1:02d}"


def month_sequence(start: str, end: str) -> list[str]:
    first, last = _index(start), _index(end)
    if first > last:
        raise ValueError(f"month window starts after its end: {start} > {end}")
    return [_month(i) for i in range(first, last + 1)]


def previous_month(day: date | None = None) -> str:
    day = day or date.today()
    return _month(day.year * 12 + day.month - 2)


def month_bounds(month: str) -> tuple[datetime, datetime]:
    """First instant of the month and of the next one."""
    index = _index(month)
    return tuple(datetime.strptime(_month(i), "%Y-%m") for i in (index, index + 1))


def window_dates(start: str, end: str) -> tuple[date, date]:
    """First and last calendar day of an inclusive month window."""
    return month_bounds(start)[0].date(), (month_bounds(end)[1] - timedelta(days=1)).date()


def in_window(column: Column, start: datetime, end: datetime) -> Column:
    """Half-open window over a timestamp column.

    Bounds are text cast in the session time zone: they fold to literals, reach the
    Parquet scan as filters, and do not depend on the driver's own time zone.
    """
    low, high = (F.lit(bound.isoformat(sep=" ")).cast("timestamp") for bound in (start, end))
    return (column >= low) & (column < high)


def month_of_name(name: Column) -> Column:
    """Month in a file name, or an empty string when it holds none."""
    return F.regexp_extract(name, MONTH_PATTERN, 1)


def month_start(instant: Column) -> Column:
    """First day of the month: a cheap grouping key, formatted once per group afterwards."""
    return F.trunc(instant.cast("date"), "month")


def month_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")
