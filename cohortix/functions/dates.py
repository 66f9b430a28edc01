"""Date and window predicates with the warehouse's string-bound semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ts_lit(s: str) -> Column:
    """A date or timestamp string as a timestamp_ntz literal ('1998-12-31'
    means midnight, as a string bound does in the warehouse)."""
    return F.to_timestamp_ntz(F.lit(s))


def day_after(s: str) -> Column:
    return F.to_timestamp_ntz(F.date_add(F.to_date(F.lit(s)), 1))


def in_window(col: Column | str, start: str, end: str, inclusive_days: bool = False) -> Column:
    """Inclusive range filter against date strings.

    ``inclusive_days=False``: ``col <= end`` compares with midnight of the end
    date (faithful).  ``True``: the whole end day is inside (``< end + 1d``).
    """
    c = F.col(col) if isinstance(col, str) else col
    if inclusive_days:
        return (c >= ts_lit(start)) & (c < day_after(end))
    return c.between(ts_lit(start), ts_lit(end))


def in_window_halfopen(col: Column | str, start: str, end: str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return (c >= ts_lit(start)) & (c < ts_lit(end))


def calendar_days(later: Column, earlier: Column) -> Column:
    """date_diff(later, earlier, day): calendar-day difference as int."""
    return F.datediff(F.to_date(later), F.to_date(earlier)).cast("int")


def elapsed_days(later: Column, earlier: Column) -> Column:
    """Whole 24-hour periods between two timestamps (the alternative mode)."""
    return F.timestamp_diff("DAY", earlier, later).cast("int")
