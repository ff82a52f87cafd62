"""Monthly trends and overview figures (q2, q9, q10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.numeric import mean_money
from ledgerlens.functions.temporal import month_start
from ledgerlens.operators.common import completed, sort_keys


def monthly_trends(
    transactions: DataFrame,
    *,
    with_mean: bool = True,
    status: str = "completed",
    date_col: str = "transaction_date",
    amount_col: str = "amount",
    id_col: str = "transaction_id",
) -> DataFrame:
    """Per calendar month: count, exact sum and (optionally) mean at 2 digits.

    One filtered scan and one aggregation; the partial aggregate runs before
    the shuffle, so a month holding most rows costs nothing extra.
    """
    monthly = (
        completed(transactions, status)
        .groupBy(month_start(date_col).alias("transaction_month"))
        .agg(
            F.count(id_col).alias("transaction_volume"),
            F.sum(amount_col).alias("total_value"),
        )
    )
    return _with_mean(monthly, with_mean)


def monthly_trends_from_partials(partials: DataFrame, *, with_mean: bool = True, status: str = "completed") -> DataFrame:
    """q2, q10 from kept partials (day, status)."""
    monthly = (
        completed(partials, status)
        .groupBy(month_start("transaction_date").alias("transaction_month"))
        .agg(F.sum("transaction_count").alias("transaction_volume"), F.sum("daily_amount").alias("total_value"))
    )
    return _with_mean(monthly, with_mean)


def _with_mean(monthly: DataFrame, with_mean: bool) -> DataFrame:
    cols = ["transaction_month", "transaction_volume", "total_value"]
    if with_mean:
        monthly = monthly.withColumn("average_value", mean_money("total_value", "transaction_volume"))
        cols.append("average_value")
    return monthly.select(*cols).orderBy(*sort_keys("transaction_month"))


def overview_kpis(
    transactions: DataFrame,
    *,
    status: str = "completed",
    amount_col: str = "amount",
    id_col: str = "transaction_id",
) -> DataFrame:
    """One row: completed count, volume and mean; zeros on empty input (a6).

    The mean is the exact sum over the count, converted once to a double.
    """
    agg = completed(transactions, status).agg(
        F.count(id_col).alias("total_tx_count"),
        F.sum(amount_col).alias("s"),
    )
    return _kpis(agg)


def overview_kpis_from_partials(partials: DataFrame, *, status: str = "completed") -> DataFrame:
    """q9 from kept partials (day, status)."""
    count = F.coalesce(F.sum("transaction_count"), F.lit(0).cast("long"))
    return _kpis(completed(partials, status).agg(count.alias("total_tx_count"), F.sum("daily_amount").alias("s")))


def _kpis(agg: DataFrame) -> DataFrame:
    return agg.select(
        "total_tx_count",
        F.coalesce(F.col("s").cast("double"), F.lit(0.0)).alias("total_tx_volume"),
        F.coalesce(
            F.when(F.col("total_tx_count") > 0, F.col("s").cast("double") / F.col("total_tx_count")),
            F.lit(0.0),
        ).alias("avg_tx_value"),
    )
