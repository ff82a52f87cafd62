"""Ledger rules the source generator builds in, audited over whole tables (r1-r11).

Each rule audit returns ``(rule, checked_rows, violations)`` like the
constraint audits.  Joins of the transaction fact to a dimension are preceded
by a partial aggregate on (key, compared value), so the work per key is
bounded by the number of distinct compared values, not by its row count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.numeric import cents, round_ratio_percent
from ledgerlens.functions.temporal import seconds_between
from ledgerlens.operators.common import completed
from ledgerlens.operators.integrity import _explode_rules, union_all

DAY = 86_400
HOUR = 3_600


def _rule(df: DataFrame, name: str, violation: Column, weight: str | None = None) -> DataFrame:
    """One rule row from a frame and a violation predicate (optionally
    weighted by a pre-aggregated count column)."""
    w = F.col(weight) if weight else F.lit(1)
    agg = df.agg(
        F.sum(w).alias("checked"),
        F.sum(F.when(F.coalesce(violation, F.lit(False)), w).otherwise(0)).alias("v"),
    ).fillna(0)
    return _explode_rules(agg, [(name, "v")])


def _rules(df: DataFrame, checks: dict[str, Column], weight: str | None = None) -> DataFrame:
    """Several rules over one frame in one pass."""
    w = F.col(weight) if weight else F.lit(1)
    aggs = [F.sum(w).alias("checked")]
    names = []
    for i, (name, cond) in enumerate(checks.items()):
        aggs.append(F.sum(F.when(F.coalesce(cond, F.lit(False)), w).otherwise(0)).alias(f"v{i}"))
        names.append((name, f"v{i}"))
    return _explode_rules(df.agg(*aggs).fillna(0), names)


def temporal_order(customers: DataFrame, accounts: DataFrame, merchants: DataFrame, transactions: DataFrame) -> DataFrame:
    """r1: account opened on/after joining; transaction on/after the account
    opened and on/after the merchant registered."""
    acc = accounts.select("customer_id", "opened_date").join(customers.select("customer_id", "join_date"), "customer_id")
    r_acc = _rule(acc, "temporal:account_opened>=customer_joined", F.col("opened_date") < F.col("join_date"))

    tx_days = transactions.select("account_id", "merchant_id", F.to_date("transaction_date").alias("day"))
    per_acct = tx_days.groupBy("account_id", "day").agg(F.count(F.lit(1)).alias("n"))
    j_acct = per_acct.join(accounts.select("account_id", "opened_date"), "account_id")
    r_tx = _rule(j_acct, "temporal:transaction>=account_opened", F.col("day") < F.col("opened_date"), "n")

    per_merch = tx_days.where(F.col("merchant_id").isNotNull()).groupBy("merchant_id", "day").agg(
        F.count(F.lit(1)).alias("n"))
    j_m = per_merch.join(merchants.select("merchant_id", "registration_date"), "merchant_id")
    r_m = _rule(j_m, "temporal:transaction>=merchant_registered", F.col("day") < F.col("registration_date"), "n")
    return union_all([r_acc, r_tx, r_m])


def ship_after_order(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """r1 on the driver tables (naturally dirty): lines shipped before their
    order date.  Lines are counted per (order, ship date) before the join."""
    per = lineitem.groupBy("l_orderkey", "l_shipdate").agg(F.count(F.lit(1)).alias("n"))
    j = per.join(orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey")
    return _rule(j, "temporal:lineitem.l_shipdate>=orders.o_orderdate", F.col("l_shipdate") < F.col("o_orderdate"), "n")


def _settled(settlements: DataFrame, transactions: DataFrame) -> DataFrame:
    return settlements.join(
        transactions.select("transaction_id", "merchant_id", "amount", "transaction_date"), "transaction_id"
    )


def settlement_window(settlements: DataFrame, transactions: DataFrame, lo_days: int = 1, hi_days: int = 6) -> DataFrame:
    """r2: settled at least ``lo_days`` and less than ``hi_days`` after."""
    secs = seconds_between("transaction_date", "settlement_date")
    return _rule(_settled(settlements, transactions), f"window:settlement_in[{lo_days}d,{hi_days}d)",
                 (secs < lo_days * DAY) | (secs >= hi_days * DAY))


# Fee bands in basis points by merchant risk tier (source generator).
FEE_BANDS_BP = {"high": (350, 500), "medium": (200, 300), "low": (100, 180)}


def fee_band(settlements: DataFrame, transactions: DataFrame, merchants: DataFrame, tolerance_cents: float = 0.5) -> DataFrame:
    """r3: fee / amount inside the band of the merchant's tier, allowing half a
    cent for rounding.  Exact: ``10000 * fee_c`` against ``amount_c * bp``.

    The band depends on the merchant's tier, which is only known after the
    merchant join.  So each settlement is first checked against *every* band
    and counted per merchant (one conditional count per tier, map-side
    partial aggregation); the merchant join then sees one row per merchant
    and picks the count of its own tier.
    """
    s = _settled(settlements, transactions).where(F.col("merchant_id").isNotNull())
    fee = cents("processing_fee") * 10000
    amt = cents("amount")
    tol = int(tolerance_cents * 10000)
    counts = [F.count(F.lit(1)).alias("n")]
    for tier, (lo, hi) in FEE_BANDS_BP.items():
        outside = (fee < amt * lo - tol) | (fee > amt * hi + tol)
        counts.append(F.count_if(outside).alias(f"bad_{tier}"))
    per = s.groupBy("merchant_id").agg(*counts)
    j = per.join(merchants.select("merchant_id", "risk_tier"), "merchant_id")
    tier = F.col("risk_tier")
    own = (F.when(tier == "high", F.col("bad_high")).when(tier == "medium", F.col("bad_medium"))
           .otherwise(F.col("bad_low")))
    agg = j.agg(F.sum("n").alias("checked"), F.sum(own).alias("v")).fillna(0)
    return _explode_rules(agg, [("fee_band:processing_fee/amount_in_tier_band", "v")])


def settlement_balance(settlements: DataFrame, transactions: DataFrame) -> DataFrame:
    """r4: settled = max(amount - fee, 0) and settled >= 0."""
    s = _settled(settlements, transactions)
    expected = F.greatest(F.col("amount") - F.col("processing_fee"), F.lit(0))
    return _rules(s, {
        "balance:settled_amount=greatest(amount-fee,0)": F.col("settled_amount") != expected,
        "balance:settled_amount>=0": F.col("settled_amount") < 0,
    })


def merchant_presence(transactions: DataFrame) -> DataFrame:
    """r5: the merchant is NULL exactly for transfers."""
    return _rule(transactions, "presence:merchant_null<=>transfer",
                 F.col("merchant_id").isNull() != (F.col("transaction_type") == "transfer"))


def currency_match(transactions: DataFrame, accounts: DataFrame) -> DataFrame:
    """r6: a transaction's currency is its account's currency."""
    per = transactions.groupBy("account_id", "currency").agg(F.count(F.lit(1)).alias("n"))
    j = per.join(accounts.select("account_id", F.col("currency").alias("account_currency")), "account_id")
    return _rule(j, "currency:transaction=account", F.col("currency") != F.col("account_currency"), "n")


def flag_timing(fraud_flags: DataFrame, transactions: DataFrame) -> DataFrame:
    """r7: flagged 0 to < 4 h after; resolved date present exactly when
    resolved, 1 to < 8 days after the flag."""
    j = fraud_flags.join(transactions.select("transaction_id", "transaction_date"), "transaction_id")
    delay = seconds_between("transaction_date", "flagged_date")
    res = seconds_between("flagged_date", "resolved_date")
    return _rules(j, {
        "flag:flagged_in[0h,4h)": (delay < 0) | (delay >= 4 * HOUR),
        "flag:resolved_date<=>is_resolved": F.col("resolved_date").isNotNull() != F.col("is_resolved"),
        "flag:resolved_in[1d,8d)": F.col("is_resolved") & ((res < DAY) | (res >= 8 * DAY)),
    })


def settlement_backlog(transactions: DataFrame, settlements: DataFrame, merchants: DataFrame) -> DataFrame:
    """r8: completed transactions with a merchant and no settlement, by category."""
    eligible = completed(transactions).where(F.col("merchant_id").isNotNull()).select("transaction_id", "merchant_id")
    missing = eligible.join(settlements.select("transaction_id"), "transaction_id", "left_anti")
    per = missing.groupBy("merchant_id").agg(F.count(F.lit(1)).alias("n"))
    return (
        per.join(merchants.select("merchant_id", "category"), "merchant_id")
        .groupBy("category").agg(F.sum("n").alias("backlog_transactions"))
    )


def fixed_size_sample(df: DataFrame, key: str, n: int, mult: int = 7919, mod: int = 1000003) -> DataFrame:
    """r9: ``n`` rows without replacement, the same on every run: ordered by a
    fixed hash of the key, then the key; a distributed top-n (limit is the
    feature here)."""
    h = (F.col(key) * mult) % mod
    return df.orderBy(h.asc(), F.col(key).asc()).limit(n)


def coverage(parent: DataFrame, child: DataFrame, parent_col: str, child_col: str, name: str) -> DataFrame:
    """r10: parents without any child row (left join on distinct child keys)."""
    kids = child.select(F.col(child_col).alias(parent_col)).distinct().withColumn("_hit", F.lit(1))
    j = parent.select(parent_col).join(kids, parent_col, "left")
    return _rule(j, name, F.col("_hit").isNull())


def share_profile(df: DataFrame, column: str, label: str) -> DataFrame:
    """r11: share of each value of a column, percent at 2 digits.

    The total is a second aggregate, a scalar subquery, so a column with any number of
    values is never gathered in one task."""
    g = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("row_count"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return g.select(F.lit(label).alias("profile"), "value", "row_count",
                    round_ratio_percent("row_count", total, 2).alias("share_pct"))
