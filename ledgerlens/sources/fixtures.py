"""Derive the six ledger tables from the driver's TPC-H style tables.

The rules are the ones written down in FIXTURES.md section 3; the DuckDB oracle
(:mod:`ledgerlens.plans.oracle_mapping`) states the same rules in SQL.  Everything is a
projection, a join or a per-order window, so the derivation scales with the
input:

* every ``lineitem`` row becomes one transaction.  Its id is built from the order
  key, the line number and a running number among equal line numbers, so the only
  window is over (order, line number) and an order of any size is spread by its lines.
* an order's account follows from the order alone, so ``orders`` is joined to
  ``accounts`` first (``orders`` is a quarter of ``lineitem``) and the result
  meets ``lineitem`` on the order key.
* dimension joins (``nation``, ``merchants``) carry no hints: the planner
  broadcasts a side only when its measured size is under the threshold and
  keeps a shuffle join otherwise.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.functions.temporal import add_seconds
from ledgerlens.sources.schemas import MONEY, conform

# Fixed values that must equal the source generator's lists (in source order).
CATEGORIES = [
    "Retail", "Travel", "Entertainment", "Electronics",
    "Utilities", "Food & Beverage", "Services", "Healthcare",
]
FLAG_REASONS = [
    "Velocity Limit Exceeded",
    "High Risk Country Match",
    "Suspicious Amount Spike",
    "Mismatched Billing Details",
    "Card-Not-Present Anomaly",
]
# Fixed values of the source generator: the currencies of accounts, in its order.
CURRENCY_CYCLE = ["EUR", "EUR", "GBP", "AUD", "CAD"]
# Fixed values of the mapping itself (FIXTURES.md section 3).
EPOCH = dt.date(1995, 1, 1)
H_MULT, H_MOD = 7919, 1000003
G_MULT, G_MOD = 104729, 999983

DRIVER_COLUMNS = {
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "nation": ["n_nationkey", "n_name"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey"],
    "orders": ["o_orderkey", "o_custkey"],
    "lineitem": [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_shipdate",
    ],
}


def read_driver(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """One driver table, pruned to the columns the mapping uses."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    cols = columns if columns is not None else DRIVER_COLUMNS.get(name)
    return df.select(*cols) if cols else df


def pick(values: list[str], index: Column) -> Column:
    """``values[index]`` for a 0-based integer column."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def h_of(transaction_id: Column) -> Column:
    return ((transaction_id % H_MOD) * H_MULT) % H_MOD


def g_of(transaction_id: Column) -> Column:
    return ((transaction_id % G_MOD) * G_MULT) % G_MOD


def extended(key: Column, number: Column) -> Column:
    """``key`` with ``number`` (0 or more) appended so that no two pairs give the same
    value, whatever the numbers: the number's two-digit groups, then how many there are."""
    groups = F.ceil(F.greatest(F.length(number.cast("string")), F.lit(1)) / 2).cast("int")
    return (key * F.pow(F.lit(100.0), groups).cast("long") + number) * 10 + groups


def derive_customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    c = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    seg = F.col("c_mktsegment")
    out = c.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("full_name"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        F.col("n_name").alias("country"),
        F.date_add(F.lit(EPOCH), ((F.col("c_custkey") * 37) % 1460).cast("int")).alias("join_date"),
        F.when(seg == "MACHINERY", "business").when(seg == "FURNITURE", "premium")
        .otherwise("retail").alias("segment"),
        (F.col("c_acctbal") > 0).alias("is_active"),
    )
    return conform(out, "customers")


def derive_accounts(customers: DataFrame) -> DataFrame:
    cid = F.col("customer_id")
    # One account per customer, a second one for every fifth customer.
    with_k = customers.select(
        "customer_id", "join_date",
        F.explode(F.when(cid % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("k"),
    )
    k = F.col("k")
    out = with_k.select(
        (cid * 2 + k).alias("account_id"),
        cid.alias("customer_id"),
        F.when(cid % 20 < 12, "current").when(cid % 20 < 19, "savings").otherwise("merchant").alias("account_type"),
        pick(CURRENCY_CYCLE, (cid + k) % 5).alias("currency"),
        F.col("join_date").alias("opened_date"),
        F.when((cid + k) % 100 < 92, "active").when((cid + k) % 100 < 97, "closed")
        .otherwise("suspended").alias("status"),
    )
    return conform(out, "accounts")


def derive_merchants(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    s = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
    key = F.col("s_suppkey")
    tier = (key * 7919) % 100
    out = s.select(
        key.alias("merchant_id"),
        F.col("s_name").alias("merchant_name"),
        pick(CATEGORIES, key % 8).alias("category"),
        F.col("n_name").alias("country"),
        F.lit(EPOCH).alias("registration_date"),
        F.when(tier < 85, "low").when(tier < 97, "medium").otherwise("high").alias("risk_tier"),
    )
    return conform(out, "merchants")


LINE_ORDER = [
    "l_partkey", "l_suppkey", "l_shipdate",
    "l_extendedprice", "l_quantity", "l_discount", "l_tax",
]


def derive_transactions(lineitem: DataFrame, orders: DataFrame, accounts: DataFrame) -> DataFrame:
    # Account of each order, with the account's currency and opening date.
    cust = F.col("o_custkey")
    order_acct = orders.select(
        "o_orderkey",
        (cust * 2 + F.when(cust % 5 == 0, F.col("o_orderkey") % 2).otherwise(0)).alias("account_id"),
    ).join(accounts.select("account_id", "currency", "opened_date"), "account_id")

    # Line numbers repeat inside an order; a running number tells those lines apart.
    same_line = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(*LINE_ORDER)
    lines = lineitem.select(
        "l_orderkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_linenumber",
        (F.row_number().over(same_line) - 1).cast("long").alias("nth"),
    ).withColumn("transaction_id", extended(extended(F.col("l_orderkey"), F.col("l_linenumber").cast("long")), F.col("nth")))
    # Both sides grow with the data: no hint, so the join can spill and AQE can
    # split an order with an outsized share of the lines.
    joined = lines.join(order_acct, lines.l_orderkey == order_acct.o_orderkey)
    # No transaction before its account opened: the ship date, counted from the
    # mapping's first day, is counted from the day the account opened.
    shift = F.datediff("opened_date", F.lit(EPOCH)).cast("long") * 86400
    tid = F.col("transaction_id")
    h, g = h_of(tid), g_of(tid)
    out = joined.select(
        tid,
        "account_id",
        F.when(g % 100 < 85, F.col("l_suppkey")).alias("merchant_id"),
        F.col("l_extendedprice").cast(MONEY).alias("amount"),
        "currency",
        add_seconds("l_shipdate", shift + h % 86400).alias("transaction_date"),
        F.when(g % 100 < 80, "purchase").when(g % 100 < 85, "refund").otherwise("transfer").alias("transaction_type"),
        F.when(h % 100 < 90, "completed").when(h % 100 < 98, "failed").otherwise("pending").alias("status"),
    )
    return conform(out, "transactions")


def derive_settlements(transactions: DataFrame, merchants: DataFrame) -> DataFrame:
    tid = F.col("transaction_id")
    h, g = h_of(tid), g_of(tid)
    eligible = transactions.where((F.col("status") == "completed") & (g % 50 != 0)).select(
        "transaction_id", "merchant_id", "amount", "transaction_date"
    )
    # Row-level lookup of the merchant's tier.  The merchant table is
    # broadcast when AQE measures it small; otherwise a shuffle join whose
    # hot merchant partitions AQE's skew-join handling splits.
    j = eligible.join(merchants.select("merchant_id", "risk_tier"), "merchant_id")
    tier = F.col("risk_tier")
    bp = (
        F.when(tier == "high", 350 + h % 151)
        .when(tier == "medium", 200 + h % 101)
        .otherwise(100 + h % 81)
    )
    fee = F.round(F.col("amount") * bp.cast("int") * F.lit(0.0001).cast("decimal(4,4)"), 2).cast(MONEY)
    delay = (1 + h % 5) * 86400 + (g % 24) * 3600 + (g % 60) * 60
    out = j.select(
        tid.alias("settlement_id"),
        tid,
        add_seconds("transaction_date", delay).alias("settlement_date"),
        F.greatest(F.col("amount") - fee, F.lit(0).cast(MONEY)).cast(MONEY).alias("settled_amount"),
        fee.alias("processing_fee"),
        F.when(h % 100 < 84, "settled").when(h % 100 < 89, "delayed").otherwise("disputed").alias("status"),
    )
    return conform(out, "settlements")


def derive_fraud_flags(transactions: DataFrame) -> DataFrame:
    tid = F.col("transaction_id")
    h, g = h_of(tid), g_of(tid)
    flagged = add_seconds("transaction_date", (g % 4) * 3600 + (g % 60) * 60)
    resolved = g % 10 < 8
    out = transactions.where(h % 32 == 5).select(
        tid.alias("flag_id"),
        tid,
        flagged.alias("flagged_date"),
        pick(FLAG_REASONS, g % 5).alias("flag_reason"),
        resolved.alias("is_resolved"),
        F.when(resolved, add_seconds(flagged, (1 + g % 7) * 86400 + (g % 24) * 3600)).alias("resolved_date"),
    )
    return conform(out, "fraud_flags")
