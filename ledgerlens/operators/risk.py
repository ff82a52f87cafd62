"""Fraud rates per merchant against the category benchmark (q5, q12, k1, a8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.numeric import round_ratio, round_ratio_percent
from ledgerlens.operators.common import sort_keys


def merchant_flag_counts(transactions: DataFrame, fraud_flags: DataFrame) -> DataFrame:
    """Per merchant: all transactions (any status) and how many are flagged.

    A left join keeps unflagged transactions; ``count(flag_id)`` skips their
    NULLs (a1).  Flags are unique per transaction, so the join does not fan
    out.  The result has one row per merchant, ready for dimension joins.
    """
    t = transactions.where(F.col("merchant_id").isNotNull()).select("transaction_id", "merchant_id")
    f = fraud_flags.select("transaction_id", "flag_id")
    return (
        t.join(f, "transaction_id", "left")
        .groupBy("merchant_id")
        .agg(
            F.count("transaction_id").alias("total_transactions"),
            F.count("flag_id").alias("flagged_transactions"),
        )
    )


def merchant_activity(transactions: DataFrame, fraud_flags: DataFrame, settlements: DataFrame) -> DataFrame:
    """Per merchant: transactions, flagged transactions and settled amount of completed ones, each fact read once.

    Settlements are summed per transaction first, so several of one transaction don't multiply
    its counts; the three tables are bucketed on the transaction, so nothing is shuffled
    before the aggregate by merchant.  A merchant without settled revenue has NULL."""
    t = transactions.where(F.col("merchant_id").isNotNull()).select("transaction_id", "merchant_id", "status")
    paid = settlements.groupBy("transaction_id").agg(F.sum("settled_amount").alias("paid"))
    f = fraud_flags.groupBy("transaction_id").agg(F.count("flag_id").alias("flags"))
    joined = t.join(f, "transaction_id", "left").join(paid, "transaction_id", "left")
    return joined.groupBy("merchant_id").agg(
        F.sum(F.greatest(F.coalesce("flags", F.lit(0)), F.lit(1))).alias("total_transactions"),
        F.coalesce(F.sum("flags"), F.lit(0)).alias("flagged_transactions"),
        F.sum(F.when(F.col("status") == "completed", F.col("paid"))).alias("total_revenue"),
    )


def category_benchmark(metrics: DataFrame, group_col: str = "category") -> DataFrame:
    """a8: pooled rate per group as a ratio of sums (kept as the two sums)."""
    return metrics.groupBy(group_col).agg(
        F.sum("flagged_transactions").alias("cat_flagged"),
        F.sum("total_transactions").alias("cat_total"),
    )


def risk_indicators(
    transactions: DataFrame,
    merchants: DataFrame,
    fraud_flags: DataFrame,
    *,
    min_transactions: int = 20,
) -> DataFrame:
    """q5: merchants whose flag rate is strictly above their category's pooled
    rate and that have at least ``min_transactions`` transactions.

    The comparison is exact (``flagged * cat_total > cat_flagged * total``) on
    unrounded rates; the output rates are rounded to 4 digits.  The category
    sums are a small aggregate joined back (the planner broadcasts it once its
    size is measured), instead of a window that would put each category in
    one task.
    """
    metrics = merchants.select("merchant_id", "merchant_name", "category").join(
        merchant_flag_counts(transactions, fraud_flags), "merchant_id"
    )
    bench = category_benchmark(metrics)
    j = metrics.join(bench, "category")
    above = j.where(
        (
            F.col("flagged_transactions").cast("decimal(38,0)") * F.col("cat_total")
            > F.col("cat_flagged").cast("decimal(38,0)") * F.col("total_transactions")
        )
        & (F.col("total_transactions") >= min_transactions)
    )
    return above.select(
        "merchant_id",
        "merchant_name",
        "category",
        "total_transactions",
        "flagged_transactions",
        round_ratio("flagged_transactions", "total_transactions", 4).alias("merchant_fraud_rate"),
        round_ratio("cat_flagged", "cat_total", 4).alias("category_avg_fraud_rate"),
    ).orderBy(*sort_keys("-merchant_fraud_rate", "-total_transactions", "merchant_id"))


def fraud_rate_by(
    transactions: DataFrame,
    merchants: DataFrame,
    fraud_flags: DataFrame,
    by: str = "category",
) -> DataFrame:
    """q12 (by category) / k1 (by risk tier): flagged share in percent, 2 digits."""
    counts = merchant_flag_counts(transactions, fraud_flags)
    grouped = (
        counts.join(merchants.select("merchant_id", by), "merchant_id")
        .groupBy(by)
        .agg(
            F.sum("total_transactions").alias("total_transactions"),
            F.sum("flagged_transactions").alias("flagged_transactions"),
        )
    )
    return grouped.select(
        by,
        "total_transactions",
        "flagged_transactions",
        round_ratio_percent("flagged_transactions", "total_transactions", 2).alias("fraud_rate_pct"),
    ).orderBy(*sort_keys("-fraud_rate_pct", by))


def fraud_rate_by_tier(transactions: DataFrame, merchants: DataFrame, fraud_flags: DataFrame) -> DataFrame:
    """k1: fraud rate per risk tier and its ratio to the low tier (2 digits).

    ratio = (f_t / n_t) / (f_low / n_low) = f_t * n_low / (n_t * f_low), exact.
    NULL when the low tier is absent or has no flags.
    """
    by_tier = fraud_rate_by(transactions, merchants, fraud_flags, by="risk_tier")
    # One row per tier: the window below spans a handful of aggregated rows.
    everything = Window.partitionBy()
    is_low = F.col("risk_tier") == "low"
    j = by_tier.select(
        "*",
        F.max(F.when(is_low, F.col("total_transactions"))).over(everything).alias("low_total"),
        F.max(F.when(is_low, F.col("flagged_transactions"))).over(everything).alias("low_flagged"),
    )
    return j.select(
        "risk_tier",
        "total_transactions",
        "flagged_transactions",
        "fraud_rate_pct",
        F.when(
            F.col("low_flagged") > 0,
            round_ratio(
                F.col("flagged_transactions").cast("decimal(38,0)") * F.col("low_total"),
                F.col("total_transactions").cast("decimal(38,0)") * F.col("low_flagged"),
                2,
            ),
        ).alias("ratio_to_low"),
    ).orderBy(*sort_keys("risk_tier"))
