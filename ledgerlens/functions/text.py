"""Display labels and derived text (f13-f15)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.functions.numeric import int_div


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def thousands(c) -> Column:
    """Whole number with thousands separators: ``1,234``."""
    return F.format_number(_col(c).cast("long"), 0)


def fixed2(units) -> Column:
    """Integer hundredths as ``1,234.50`` (no binary rounding involved)."""
    u = _col(units).cast("decimal(38,0)")
    whole = int_div(F.abs(u), F.lit(100))
    frac = F.lpad((F.abs(u) % 100).cast("long").cast("string"), 2, "0")
    sign = F.when(u < 0, F.lit("-")).otherwise(F.lit(""))
    return F.concat(sign, thousands(whole), F.lit("."), frac)


def money_label(cents, symbol: str = "€") -> Column:
    """Cents as ``€1,234.50``; ``-`` for NULL."""
    return F.coalesce(F.concat(F.lit(symbol), fixed2(cents)), F.lit("-"))


def percent_label(hundredths) -> Column:
    """Hundredths of a percent as ``12.30%``; ``-`` for NULL."""
    return F.coalesce(F.concat(fixed2(hundredths), F.lit("%")), F.lit("-"))


def email_from_name(name, key, domain: str = "example.com") -> Column:
    """Lower-case name without spaces and dots, ``_<key>@<domain>`` (f15)."""
    return F.concat(
        F.regexp_replace(F.lower(_col(name)), "[ .]", ""), F.lit("_"), _col(key).cast("string"), F.lit(f"@{domain}")
    )
