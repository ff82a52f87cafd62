"""Customer segments and segment-level findings (q1, k3, k4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.numeric import mean_money, round_ratio, round_ratio_percent, cents
from ledgerlens.operators.common import completed, sort_keys


def customer_segments(customers: DataFrame, *, min_count: int = 10) -> DataFrame:
    """q1: customers per (country, segment), groups with more than
    ``min_count`` customers, largest first (p4 HAVING)."""
    return (
        customers.groupBy("country", "segment")
        .agg(F.count("customer_id").alias("customer_count"))
        .where(F.col("customer_count") > min_count)
        .orderBy(*sort_keys("-customer_count", "country", "segment"))
    )


def segment_spend(customers: DataFrame, accounts: DataFrame, transactions: DataFrame) -> DataFrame:
    """Completed count and exact amount per customer segment.

    Per-account partial sums first, so the account and customer joins see one
    row per account rather than one per transaction.
    """
    per_account = completed(transactions).groupBy("account_id").agg(
        F.count("transaction_id").alias("n"), F.sum("amount").alias("amount")
    )
    owners = accounts.select("account_id", "customer_id").join(customers.select("customer_id", "segment"), "customer_id")
    return (
        per_account.join(owners, "account_id")
        .groupBy("segment")
        .agg(F.sum("n").alias("transaction_count"), F.sum("amount").cast("decimal(25,2)").alias("total_value"))
    )


def volume_share_by_segment(customers: DataFrame, accounts: DataFrame, transactions: DataFrame) -> DataFrame:
    """k3: each segment's share of completed volume, percent at 2 digits.

    The grand total is a window sum over the few segment rows."""
    seg = segment_spend(customers, accounts, transactions)
    total = F.sum("total_value").over(Window.partitionBy())
    return seg.select(
        "segment",
        "total_value",
        round_ratio_percent(cents("total_value"), cents(total), 2).alias("volume_share_pct"),
    ).orderBy("segment")


def avg_value_by_segment(customers: DataFrame, accounts: DataFrame, transactions: DataFrame) -> DataFrame:
    """k4: mean completed amount per segment (2 digits) and its ratio to the
    retail mean (4 digits), from exact sums: (s_x / n_x) / (s_r / n_r)."""
    seg = segment_spend(customers, accounts, transactions)
    everything = Window.partitionBy()
    is_retail = F.col("segment") == "retail"
    j = seg.select(
        "*",
        F.max(F.when(is_retail, F.col("total_value"))).over(everything).alias("r_sum"),
        F.max(F.when(is_retail, F.col("transaction_count"))).over(everything).alias("r_n"),
    )
    return j.select(
        "segment",
        "transaction_count",
        mean_money("total_value", "transaction_count").alias("avg_value"),
        F.when(
            F.col("r_sum") > 0,
            round_ratio(
                cents("total_value") * F.col("r_n"),
                F.col("transaction_count").cast("decimal(38,0)") * cents("r_sum"),
                4,
            ),
        ).alias("ratio_to_retail"),
    ).orderBy("segment")
