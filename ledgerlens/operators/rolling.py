"""Daily totals with row-based moving windows, lag and lead (q7, w3-w8).

Frames are ROWS frames over *observed* days: a day without completed
transactions has no row and is not filled.  The first frames are short.

The windows run on the daily aggregate, one row per calendar day, whose size
is bounded by the date span and not by the number of transactions; the
distributed aggregation runs first.  ``partition_cols`` (e.g. a currency or a
merchant) gives one independent series per key, so per-key series spread over
tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.numeric import cents, units_to_double, ratio_units
from ledgerlens.functions.temporal import day_of
from ledgerlens.operators.common import completed, sort_keys


def daily_totals(
    transactions: DataFrame,
    *,
    partition_cols: tuple[str, ...] = (),
    status: str = "completed",
) -> DataFrame:
    """Completed count and exact amount per calendar day (and key)."""
    return (
        completed(transactions, status)
        .groupBy(*partition_cols, day_of("transaction_date").alias("transaction_date"))
        .agg(F.count("transaction_id").alias("transaction_count"), F.sum("amount").alias("daily_amount"))
    )


def daily_totals_from_partials(partials: DataFrame, *, status: str = "completed") -> DataFrame:
    """Daily totals of one status from kept partials (day, status)."""
    return (
        completed(partials, status)
        .groupBy("transaction_date")
        .agg(F.sum("transaction_count").alias("transaction_count"), F.sum("daily_amount").alias("daily_amount"))
    )


def _rows(partition_cols: tuple[str, ...], lo: int | None = None) -> Window:
    w = Window.partitionBy(*partition_cols).orderBy("transaction_date")
    return w if lo is None else w.rowsBetween(lo, Window.currentRow)


def moving_mean(value: str, rows: int, partition_cols: tuple[str, ...] = ()):
    """Mean of the last ``rows`` observed rows at 2 digits (w5, w6), from the
    exact window sum in cents and the window row count."""
    w = _rows(partition_cols, -(rows - 1))
    return units_to_double(ratio_units(cents(F.sum(value).over(w)), F.count(value).over(w), 0), 2)


def moving_sum(value: str, rows: int, partition_cols: tuple[str, ...] = ()):
    """Exact sum of the last ``rows`` observed rows (w7)."""
    return F.sum(value).over(_rows(partition_cols, -(rows - 1)))


def rolling_metrics(transactions: DataFrame, *, partition_cols: tuple[str, ...] = ()) -> DataFrame:
    """q7: daily count and amount, 7/30-row means, 30-row sum, previous and
    next day's amount and the change from the previous day."""
    return rolling_from_daily(daily_totals(transactions, partition_cols=partition_cols), partition_cols=partition_cols)


def rolling_from_daily(daily: DataFrame, *, partition_cols: tuple[str, ...] = ()) -> DataFrame:
    """q7 from daily totals (one row per observed day and key)."""
    ordered = _rows(partition_cols)
    prev = F.lag("daily_amount", 1).over(ordered)
    return daily.select(
        *partition_cols,
        "transaction_date",
        "transaction_count",
        "daily_amount",
        moving_mean("daily_amount", 7, partition_cols).alias("rolling_avg_7d"),
        moving_mean("daily_amount", 30, partition_cols).alias("rolling_avg_30d"),
        moving_sum("daily_amount", 30, partition_cols).alias("rolling_sum_30d"),
        prev.alias("prev_day_amount"),
        F.lead("daily_amount", 1).over(ordered).alias("next_day_amount"),
        (F.col("daily_amount") - prev).alias("day_over_day_change"),
    ).orderBy(*sort_keys(*partition_cols, "transaction_date"))
