"""Join-month cohorts and their retention (q6, q13, q14, k5, p6, w2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.numeric import round_ratio, round_ratio_percent
from ledgerlens.functions.temporal import month_number, month_start, year_month_label
from ledgerlens.operators.common import completed, sort_keys

#: Months of an activity word (the bits of a long).
WORD = 64


def customer_cohorts(customers: DataFrame) -> DataFrame:
    """customer_id -> cohort_month (month of joining, DATE)."""
    return customers.select("customer_id", month_start("join_date").alias("cohort_month"))


def cohort_sizes(customers: DataFrame) -> DataFrame:
    """All customers of a cohort, active or not."""
    return customer_cohorts(customers).groupBy("cohort_month").agg(F.count("customer_id").alias("cohort_size"))


def _active_words(customers: DataFrame, accounts: DataFrame, transactions: DataFrame) -> DataFrame:
    """(customer_id, cohort_month, block, word): a customer's completed activity as bits.

    Months are numbered from year 0 on; ``block`` is that number by 64, and bit k of
    ``word`` says that the customer was active in month ``64 * block + k``.  Words merge
    by ``bit_or``: on the map side, per account, so that an account with a huge share of
    the rows is one word a block before any join, then per customer.
    """
    number = month_number("transaction_date")
    month = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(number, F.lit(WORD)))
    per_account = (
        completed(transactions)
        .where(F.col("transaction_date").isNotNull())
        .groupBy("account_id", F.floor(number / WORD).cast("int").alias("block"))
        .agg(F.bit_or(month).alias("word"))
    )
    owners = accounts.select("account_id", "customer_id").join(customer_cohorts(customers), "customer_id")
    return per_account.join(owners, "account_id").groupBy("customer_id", "cohort_month", "block").agg(F.bit_or("word").alias("word"))


def _has_bit(k) -> Column:
    return F.call_function("shiftright", F.col("word"), k if isinstance(k, Column) else F.lit(k)).bitwiseAND(F.lit(1).cast("long"))


def monthly_active_customers(customers: DataFrame, accounts: DataFrame, transactions: DataFrame) -> DataFrame:
    """p6: distinct (customer, cohort month, activity month) of completed activity.

    One row per bit of the customers' words: they are distinct as they stand, so the
    months are spelled out after the last exchange.  The reference joins the customer
    table twice on the same unique key; once is enough.
    """
    bits = F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda k: _has_bit(k) == 1)
    words = _active_words(customers, accounts, transactions)
    spelled = words.select("customer_id", "cohort_month", "block", F.explode(bits).alias("bit"))
    number = F.col("block") * WORD + F.col("bit")
    month = F.make_date(F.floor(number / 12).cast("int"), F.pmod(number, F.lit(12)) + 1, F.lit(1))
    return spelled.select("customer_id", "cohort_month", month.alias("activity_month"))


def cohort_retention_counts(customers: DataFrame, accounts: DataFrame, transactions: DataFrame) -> DataFrame:
    """(cohort_month, months_active_offset) -> active customers.

    Every bit position is counted by itself in one aggregate per (cohort, block), so no
    month is spelled out per customer; only the counts of the few (cohort, block) rows
    are turned into rows, less the cohort's own month number.  Customers without a join
    date belong to no cohort.
    """
    words = _active_words(customers, accounts, transactions).where(F.col("cohort_month").isNotNull())
    counted = words.groupBy("cohort_month", "block").agg(*[F.sum(_has_bit(k)).alias(str(k)) for k in range(WORD)])
    cells = counted.unpivot(["cohort_month", "block"], [str(k) for k in range(WORD)], "bit", "active_customers")
    offset = F.col("block") * WORD + F.col("bit").cast("int") - month_number("cohort_month")
    return cells.where(F.col("active_customers") > 0).select("cohort_month", offset.alias("months_active_offset"), "active_customers")


def cohort_analysis(customers: DataFrame, accounts: DataFrame, transactions: DataFrame) -> DataFrame:
    """q6: retention per cohort and offset, 4 digits, with the previous
    *observed* offset's active count (offsets without activity have no row)."""
    counts = cohort_retention_counts(customers, accounts, transactions)
    sized = counts.join(cohort_sizes(customers), "cohort_month")
    w = Window.partitionBy("cohort_month").orderBy("months_active_offset")
    return sized.select(
        "cohort_month",
        "cohort_size",
        "months_active_offset",
        "active_customers",
        round_ratio("active_customers", "cohort_size", 4).alias("retention_rate"),
        F.lag("active_customers").over(w).alias("prev_month_active_customers"),
    ).orderBy(*sort_keys("cohort_month", "months_active_offset"))


def _retention_pct(customers: DataFrame, accounts: DataFrame, transactions: DataFrame, max_offset: int) -> DataFrame:
    counts = cohort_retention_counts(customers, accounts, transactions).where(
        F.col("months_active_offset") <= max_offset
    )
    sized = counts.join(cohort_sizes(customers), "cohort_month")
    return sized.select(
        "cohort_month",
        "cohort_size",
        "months_active_offset",
        round_ratio_percent("active_customers", "cohort_size", 2).alias("retention_rate"),
    )


def cohort_retention_pct(
    customers: DataFrame, accounts: DataFrame, transactions: DataFrame, *, max_offset: int = 12
) -> DataFrame:
    """q13: retention in percent (2 digits) for offsets up to ``max_offset``."""
    return _retention_pct(customers, accounts, transactions, max_offset).orderBy(
        *sort_keys("cohort_month", "months_active_offset")
    )


def cohort_matrix(retention: DataFrame, *, max_offset: int = 12) -> DataFrame:
    """q14 / f12: one row per cohort (``yyyy-MM``), one column per offset
    ``"0"`` .. ``"max_offset"``; NULL where the cohort had no activity.

    Each (cohort, offset) cell is unique, so the pivot is one conditional
    aggregation per offset in a single ``groupBy`` (Spark's ``pivot`` with
    ``first`` plans a second aggregation and keeps the input's sort).
    """
    offset = F.col("months_active_offset")
    return (
        retention.groupBy(year_month_label("cohort_month").alias("cohort_month"))
        .agg(*[F.max(F.when(offset == o, F.col("retention_rate"))).alias(str(o)) for o in range(max_offset + 1)])
        .orderBy("cohort_month")
    )


def cohort_matrix_from_ledger(
    customers: DataFrame, accounts: DataFrame, transactions: DataFrame, *, max_offset: int = 12
) -> DataFrame:
    """q14 straight from the ledger (no intermediate sort)."""
    return cohort_matrix(_retention_pct(customers, accounts, transactions, max_offset), max_offset=max_offset)


def retention_at_offset_by_segment(
    customers: DataFrame, accounts: DataFrame, transactions: DataFrame, *, offset: int = 3
) -> DataFrame:
    """k5: per segment, the share (percent, 2 digits) of customers active
    exactly ``offset`` months after their join month, pooled over cohorts."""
    month = month_number("cohort_month") + offset
    active = (
        _active_words(customers, accounts, transactions)
        .where((F.col("block") == F.floor(month / WORD)) & (_has_bit(F.pmod(month, F.lit(WORD))) == 1))
        .select("customer_id")
    )
    seg = customers.select("customer_id", "segment")
    sizes = seg.groupBy("segment").agg(F.count("customer_id").alias("segment_customers"))
    hits = active.join(seg, "customer_id").groupBy("segment").agg(F.count("customer_id").alias("active_customers"))
    j = sizes.join(hits, "segment", "left").fillna(0, ["active_customers"])
    return j.select(
        "segment",
        "segment_customers",
        "active_customers",
        round_ratio_percent("active_customers", "segment_customers", 2).alias("retention_pct"),
    ).orderBy("segment")
