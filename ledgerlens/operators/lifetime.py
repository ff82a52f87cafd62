"""Customer lifetime value (q8, f5, f8, f11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.numeric import mean_money, money_per
from ledgerlens.functions.temporal import age_months
from ledgerlens.operators.common import completed, sort_keys, top_k_with_lookup


def customer_activity(accounts: DataFrame, transactions: DataFrame) -> DataFrame:
    """Per customer: completed count, exact spend, first and last transaction.

    The reference computes spend and lifespan in two CTEs over the same scan,
    filter and keys; here it is one aggregation.  Transactions are reduced
    per account first (map-side), then rolled up per customer, so a busy
    account never skews the account join.
    """
    per_account = (
        completed(transactions)
        .groupBy("account_id")
        .agg(
            F.count("transaction_id").alias("n"),
            F.sum("amount").alias("spend"),
            F.min("transaction_date").alias("first_tx"),
            F.max("transaction_date").alias("last_tx"),
        )
    )
    return (
        per_account.join(accounts.select("account_id", "customer_id"), "account_id")
        .groupBy("customer_id")
        .agg(
            F.sum("n").alias("completed_transaction_count"),
            F.sum("spend").cast("decimal(25,2)").alias("total_spend"),
            F.min("first_tx").alias("first_transaction"),
            F.max("last_tx").alias("last_transaction"),
        )
        .withColumn(
            "months_active",
            F.greatest(F.lit(1), age_months("last_transaction", "first_transaction")),
        )
    )


def customer_lifetime_value(
    customers: DataFrame, accounts: DataFrame, transactions: DataFrame, *, k: int | None = 50
) -> DataFrame:
    """q8: profile, completed count, spend, mean value (2 digits), whole months
    active (at least 1) and spend per month (2 digits); top ``k`` by spend.

    Transactions are summed per customer before the profiles are joined, and the
    top ``k`` is a distributed one (:func:`top_k_with_lookup`).
    """
    act = customer_activity(accounts, transactions)
    figures = act.select(
        "customer_id",
        "completed_transaction_count",
        F.col("total_spend").alias("customer_lifetime_value"),
        mean_money("total_spend", "completed_transaction_count").alias("avg_transaction_value"),
        "months_active",
        money_per("total_spend", "months_active").alias("revenue_per_month"),
    )
    profile = customers.select("customer_id", "full_name", "segment", "country")
    order = sort_keys("-customer_lifetime_value", "customer_id")
    if k:
        joined = top_k_with_lookup(figures, profile, "customer_id", order, k)
    else:
        joined = profile.join(figures, "customer_id").orderBy(*order)
    return joined.select(
        "customer_id", "full_name", "segment", "country", "completed_transaction_count",
        "customer_lifetime_value", "avg_transaction_value", "months_active", "revenue_per_month",
    )
