"""Exact rounding for ratios and means (f6, f10, f11, a3).

``ROUND(x, k)`` on NUMERIC rounds half away from zero on the exact value.  Spark's
``avg`` over decimals is already rounded to 6 places and ``round`` over doubles
rounds the binary value, so neither reproduces it on every input.  Here every
rounded ratio is computed from an integer numerator and denominator:

    units = (2 * num * 10^k + den) div (2 * den)        for num >= 0, den > 0

which is the ratio rounded half up, in units of 10^-k.  All arithmetic is on
``decimal(38, 0)``, so sums of cents over very large tables do not overflow.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WIDE = "decimal(38,0)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def int_div(a, b) -> Column:
    """Integer division truncating toward zero (SQL ``div``)."""
    return F.call_function("div", _col(a), _col(b))


def cents(money) -> Column:
    """Money ``decimal(p, 2)`` to a whole number of cents, exactly."""
    return (_col(money) * 100).cast(_WIDE)


def ratio_units(num, den, digits: int) -> Column:
    """``num / den`` rounded half away from zero, as an integer of 10^-digits.

    ``den`` must be positive; NULL when ``num`` or ``den`` is NULL.
    """
    n = _col(num).cast(_WIDE)
    d = _col(den).cast(_WIDE)
    scale = F.lit(2 * 10**digits).cast(_WIDE)
    up = int_div(F.abs(n) * scale + d, d * 2)
    return F.when(n >= 0, up).otherwise(-up)


def units_to_double(units, digits: int) -> Column:
    """Integer units of 10^-digits to the nearest double."""
    return _col(units).cast("double") / F.lit(float(10**digits))


def round_ratio(num, den, digits: int) -> Column:
    """Rounded ratio as a double (the exact decimal result, then converted)."""
    return units_to_double(ratio_units(num, den, digits), digits)


def round_ratio_percent(num, den, digits: int = 2) -> Column:
    """``ROUND(num / den * 100, digits)`` without an intermediate rounding."""
    return round_ratio(_col(num).cast(_WIDE) * 100, den, digits)


def mean_money(total, count) -> Column:
    """``ROUND(AVG(money), 2)`` from the exact sum and the row count."""
    return units_to_double(ratio_units(cents(total), count, 0), 2)


def money_per(total, den) -> Column:
    """``ROUND(money / den, 2)`` (e.g. spend per active month)."""
    return units_to_double(ratio_units(cents(total), den, 0), 2)


def to_double(c) -> Column:
    """Exact decimal to the nearest double, for reporting."""
    return _col(c).cast("double")
