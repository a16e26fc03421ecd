"""Calendar parts of ``timestamp_ntz`` values (no session zone involved).

Fixed values: weekday names Monday Tuesday Wednesday Thursday Friday Saturday
Sunday, reported Monday first; dates printed ``yyyy-MM-dd``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_of(c) -> Column:
    return F.to_date(_col(c))


def day_text(c) -> Column:
    return F.date_format(_col(c), "yyyy-MM-dd")


def weekday_name(c) -> Column:
    return F.date_format(_col(c), "EEEE")


def weekday_number(c) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return F.weekday(_col(c)) + F.lit(1)


def hour_of(c) -> Column:
    return F.hour(_col(c))


def whole_days_between(start, end) -> Column:
    """Floored length of ``end - start`` in days (a duration, not a boundary count)."""
    return F.timestamp_diff("DAY", _col(start), _col(end))
