"""Calendar helpers over zone-less dates and timestamps (f1-f5, f16-f18).

Everything works on DATE and TIMESTAMP_NTZ so no session time zone is involved.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_start(c) -> Column:
    """First day of the month as DATE (f1).  ``date_trunc`` would return a
    zoned timestamp; ``trunc`` keeps a DATE."""
    return F.trunc(_col(c), "MM")


def month_number(c) -> Column:
    """Months since the start of year 0, so that a month's successor is one more."""
    return F.year(_col(c)) * 12 + F.month(_col(c)) - 1


def day_of(c) -> Column:
    """Calendar day as DATE (f2)."""
    return F.to_date(_col(c))


def seconds_between(start, end) -> Column:
    """Whole seconds from ``start`` to ``end`` (f3)."""
    return F.timestamp_diff("SECOND", _col(start), _col(end))


def add_seconds(ts, seconds) -> Column:
    """``ts`` plus a number of seconds (f17)."""
    return F.timestamp_add("SECOND", _col(seconds), _col(ts))


def _month_index(c: Column) -> Column:
    return F.year(c) * 12 + F.month(c)


def _offset_in_month(c: Column) -> Column:
    ts = c.cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", F.trunc(ts, "MM").cast("timestamp_ntz"), ts)


def _whole_months_forward(end: Column, start: Column) -> Column:
    borrow = F.when(_offset_in_month(end) < _offset_in_month(start), 1).otherwise(0)
    return _month_index(end) - _month_index(start) - borrow


def age_months(end, start) -> Column:
    """Whole months of ``AGE(end, start)``: years * 12 + months (f5).

    The month count drops by one when the end's (day, time) is earlier in its
    month than the start's.  ``months_between`` and ``timestampdiff(MONTH)``
    both differ from this at month ends.
    """
    e, s = _col(end), _col(start)
    return (
        F.when(e >= s, _whole_months_forward(e, s))
        .otherwise(-_whole_months_forward(s, e))
        .cast("int")
    )


def parse_date(c) -> Column:
    """ISO ``yyyy-MM-dd`` text to DATE (f16)."""
    return F.to_date(_col(c), "yyyy-MM-dd")


def parse_timestamp(c) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text to TIMESTAMP_NTZ (f16)."""
    return F.to_timestamp_ntz(_col(c), F.lit("yyyy-MM-dd HH:mm:ss"))


def format_timestamp(c) -> Column:
    """TIMESTAMP to ``yyyy-MM-dd HH:mm:ss`` text (f18)."""
    return F.date_format(_col(c), "yyyy-MM-dd HH:mm:ss")


def year_month_label(c) -> Column:
    """``yyyy-MM`` label of a date (f13)."""
    return F.date_format(_col(c), "yyyy-MM")
