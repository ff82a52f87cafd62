"""Settled revenue per merchant, leaderboards and in-category rank (q3, q11, w1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.operators.common import completed, sort_keys, top_k_with_lookup
from ledgerlens.operators.ranking import rank_by_splitters


def settled_revenue_by_merchant(transactions: DataFrame, settlements: DataFrame) -> DataFrame:
    """(merchant_id, total_revenue): settled amounts of completed transactions.

    The transaction and settlement tables are joined on the transaction key
    (co-bucketed in the written ledger, so no shuffle) and reduced to one
    row per merchant with a map-side partial sum, so a merchant with a large
    share of all transactions never skews a later join.
    """
    tx = completed(transactions).where(F.col("merchant_id").isNotNull()).select("transaction_id", "merchant_id")
    return (
        tx.join(settlements.select("transaction_id", "settled_amount"), "transaction_id")
        .groupBy("merchant_id")
        .agg(F.sum("settled_amount").alias("total_revenue"))
    )


def merchant_settled_revenue(
    merchants: DataFrame,
    transactions: DataFrame,
    settlements: DataFrame,
    *,
    merchant_cols: tuple[str, ...] = ("merchant_name", "category", "risk_tier"),
) -> DataFrame:
    """Settled revenue with merchant attributes, one row per merchant.
    Transactions without a merchant never match (inner join semantics)."""
    per_merchant = settled_revenue_by_merchant(transactions, settlements)
    return merchants.select("merchant_id", *merchant_cols).join(per_merchant, "merchant_id")


REVENUE_ORDER = ("-total_revenue", "merchant_id")


def top_merchants_by_revenue(
    merchants: DataFrame, transactions: DataFrame, settlements: DataFrame, k: int,
    merchant_cols: tuple[str, ...] = ("merchant_name", "category", "risk_tier"),
) -> DataFrame:
    """The ``k`` merchants with the highest settled revenue, with attributes.

    Transactions are summed per merchant first, so the join with the merchant
    table moves one row per merchant (see :func:`top_k_with_lookup`).
    """
    return top_k_with_lookup(
        settled_revenue_by_merchant(transactions, settlements),
        merchants.select("merchant_id", *merchant_cols),
        "merchant_id",
        sort_keys(*REVENUE_ORDER),
        k,
    )


def top_merchants_with_rank(top: DataFrame, *, group_col: str = "category") -> DataFrame:
    """q3: RANK inside the category for the top-``k`` merchants (``top`` from
    :func:`top_merchants_by_revenue`).

    RANK counts merchants of the same category with strictly higher revenue.
    Every such merchant also ranks above the candidate overall, so it is in the
    top ``k`` as well: the in-category rank of a top-``k`` merchant can be
    computed from the ``k`` rows alone - a window over ``k`` rows instead of
    sorting every merchant of a category in one task.
    """
    w = Window.partitionBy(group_col).orderBy(F.col("total_revenue").desc_nulls_first())
    ranked = top.withColumn("category_revenue_rank", F.rank().over(w))
    return ranked.orderBy(*sort_keys(*REVENUE_ORDER))


def rank_within(df: DataFrame, group_col: str, value_col: str, out_col: str = "rank") -> DataFrame:
    """w1: RANK (with gaps) of ``value_col`` descending inside ``group_col``, for
    every row; a category of any size is ranked in pieces between its revenue quantiles."""
    return rank_by_splitters(df, [group_col], value_col, out_col)


def top_merchants(top: DataFrame) -> DataFrame:
    """q11: the top merchants by settled revenue, without the id in the output."""
    return top.orderBy(*sort_keys(*REVENUE_ORDER)).select(
        "merchant_name", "category", "risk_tier", F.coalesce("total_revenue", F.lit(0)).alias("total_revenue")
    )
