"""Settlement latency by merchant attribute (q4, k2, a9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.numeric import round_ratio
from ledgerlens.operators.common import sort_keys

MICROS_PER_DAY = 86_400 * 1_000_000


def settlement_micros(settlements: DataFrame, transactions: DataFrame) -> DataFrame:
    """Per settlement: merchant and microseconds from transaction to settlement."""
    s = settlements.select("settlement_id", "transaction_id", "settlement_date")
    t = transactions.select("transaction_id", "merchant_id", "transaction_date")
    return s.join(t, "transaction_id").select(
        "settlement_id",
        "merchant_id",
        F.timestamp_diff("MICROSECOND", F.col("transaction_date"), F.col("settlement_date")).alias("micros"),
    )


def settlement_latency(
    settlements: DataFrame,
    transactions: DataFrame,
    merchants: DataFrame,
    *,
    by: str = "category",
    out_col: str = "merchant_category",
) -> DataFrame:
    """Mean days from transaction to settlement per merchant attribute, 2 digits.

    The mean is the exact sum of microseconds over ``count * 86400e6``,
    rounded half up.  Settlements are first reduced to one row per merchant
    (count and wide-decimal sum), then joined to the merchant table and
    re-aggregated, so no merchant skews the join.
    """
    per_merchant = (
        settlement_micros(settlements, transactions)
        .where(F.col("merchant_id").isNotNull())
        .groupBy("merchant_id")
        .agg(
            F.count("settlement_id").alias("n"),
            F.sum(F.col("micros").cast("decimal(20,0)")).alias("micros"),
        )
    )
    grouped = (
        per_merchant.join(merchants.select("merchant_id", by), "merchant_id")
        .groupBy(by)
        .agg(F.sum("n").alias("settlement_count"), F.sum("micros").alias("micros"))
    )
    return grouped.select(
        F.col(by).alias(out_col),
        "settlement_count",
        round_ratio("micros", F.col("settlement_count") * MICROS_PER_DAY, 2).alias("avg_settlement_days"),
    ).orderBy(*sort_keys("avg_settlement_days", out_col))
