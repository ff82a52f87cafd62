
from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlens.functions import numeric as N
from ledgerlens.functions import temporal as T
from ledgerlens.functions import text as X
from ledgerlens.operators import cohort, lifetime, merchants, risk, rolling, rules, trends
from ledgerlens.operators.common import completed, sort_keys
from ledgerlens.plans.catalog_core import ACTIVE_MONTHS, COHORTS, EARNED, MERCHANT_FLAGS, SERIES, SPENT
from ledgerlens.plans.registry import age_months_sql, query, rr
from ledgerlens.sources.ledger import ledger_for


def _L(spark, sf_dir):
    return ledger_for(spark, sf_dir)


# ---- projections, filters, predicates --------------------------------------

@query("p1_project_alias", "SELECT customer_id AS customer_key, full_name, country, segment FROM customers")
def p1(spark, sf_dir):
    """Select and rename."""
    return _L(spark, sf_dir).customers.select(
        F.col("customer_id").alias("customer_key"), "full_name", "country", "segment"
    )


@query("p2_equality_filter", """
SELECT transaction_id, CAST(amount AS DOUBLE) AS amount, transaction_date
FROM transactions WHERE status = 'completed'
""")
def p2(spark, sf_dir):
    """status = 'completed' (pushed into the Parquet scan)."""
    return completed(_L(spark, sf_dir).transactions).select("transaction_id", "amount", "transaction_date")


@query("p3_threshold_filter", """
SELECT merchant_id, COUNT(transaction_id) AS total_transactions
FROM transactions WHERE merchant_id IS NOT NULL
GROUP BY merchant_id HAVING COUNT(transaction_id) >= 20
""")
def p3(spark, sf_dir):
    """Threshold on an aggregate: merchants with at least 20 transactions."""
    t = _L(spark, sf_dir).transactions.where(F.col("merchant_id").isNotNull())
    return (
        t.groupBy("merchant_id").agg(F.count("transaction_id").alias("total_transactions"))
        .where(F.col("total_transactions") >= 20)
    )


@query("p4_having", """
SELECT country, COUNT(customer_id) AS customer_count FROM customers
GROUP BY country HAVING COUNT(customer_id) > 10
""")
def p4(spark, sf_dir):
    """HAVING on a group count."""
    c = _L(spark, sf_dir).customers
    return c.groupBy("country").agg(F.count("customer_id").alias("customer_count")).where(F.col("customer_count") > 10)


def _merchant_metrics(L):
    return L.merchants.select("merchant_id", "category").join(
        risk.merchant_flag_counts(L.transactions, L.fraud_flags), "merchant_id"
    )


@query("p5_column_compare", f"""
WITH {MERCHANT_FLAGS}
SELECT merchant_id, category, n_tx AS total_transactions, n_flagged AS flagged_transactions
FROM pooled
WHERE n_tx >= 20 AND CAST(n_flagged AS HUGEINT) * pool_tx > CAST(pool_flagged AS HUGEINT) * n_tx
""")
def p5(spark, sf_dir):
    """Column against a joined column, combined with AND (exact cross products)."""
    m = _merchant_metrics(_L(spark, sf_dir))
    j = m.join(risk.category_benchmark(m), "category")
    cond = (
        F.col("flagged_transactions").cast("decimal(38,0)") * F.col("cat_total")
        > F.col("cat_flagged").cast("decimal(38,0)") * F.col("total_transactions")
    ) & (F.col("total_transactions") >= 20)
    return j.where(cond).select("merchant_id", "category", "total_transactions", "flagged_transactions")


@query("p6_distinct", f"""
WITH {ACTIVE_MONTHS}
SELECT customer_id, joined AS cohort_month, active AS activity_month FROM active_months
""")
def p6(spark, sf_dir):
    """Distinct (customer, cohort month, activity month) rows."""
    L = _L(spark, sf_dir)
    return cohort.monthly_active_customers(L.customers, L.accounts, L.transactions)


@query("p7_cte_chain", """
WITH monthly AS (
  SELECT CAST(date_trunc('month', transaction_date) AS DATE) AS transaction_month, SUM(amount) AS total_value
  FROM transactions WHERE status = 'completed' GROUP BY 1
),
stats AS (SELECT SUM(total_value) AS grand_total, COUNT(*) AS months FROM monthly)
SELECT m.transaction_month, CAST(m.total_value AS DOUBLE) AS total_value
FROM monthly m JOIN stats s ON TRUE
WHERE m.total_value * s.months > s.grand_total
""")
def p7(spark, sf_dir):
    """A named step used twice: months whose volume beats the mean month."""
    monthly = trends.monthly_trends(_L(spark, sf_dir).transactions, with_mean=False)
    everything = Window.partitionBy()  # over the monthly rows only
    return (
        monthly.select(
            "transaction_month", "total_value",
            F.sum("total_value").over(everything).alias("grand_total"),
            F.count("total_value").over(everything).alias("months"),
        )
        .where(F.col("total_value") * F.col("months") > F.col("grand_total"))
        .select("transaction_month", "total_value")
    )


@query("p8_group_by_alias_ordinal", """
SELECT CAST(date_trunc('month', transaction_date) AS DATE) AS transaction_month,
       COUNT(transaction_id) AS transaction_volume
FROM transactions WHERE status = 'completed'
GROUP BY 1 ORDER BY 1
""")
def p8(spark, sf_dir):
    """SQL text with GROUP BY 1 / ORDER BY 1 over temp views (s6)."""
    L = _L(spark, sf_dir)
    prefix = L.register_views()
    return spark.sql(f"""
        SELECT trunc(transaction_date, 'MM') AS transaction_month, COUNT(transaction_id) AS transaction_volume
        FROM {prefix}transactions WHERE status = 'completed'
        GROUP BY 1 ORDER BY 1
    """)


@query("p9_in_list", "SELECT customer_id, segment FROM customers WHERE segment IN ('business', 'premium')")
def p9(spark, sf_dir):
    """Membership in a literal list."""
    return _L(spark, sf_dir).customers.where(F.col("segment").isin("business", "premium")).select(
        "customer_id", "segment"
    )


@query("p10_rename_columns", f"""
WITH {EARNED}
SELECT merchant_name AS "Merchant", category AS "Category", risk_tier AS "Risk Tier",
       CAST(coalesce(revenue, 0) AS DOUBLE) AS "Revenue (EUR)"
FROM earned JOIN merchants USING (merchant_id)
ORDER BY revenue DESC, merchant_id LIMIT 10
""")
def p10(spark, sf_dir):
    """Display names on the top-merchant table."""
    L = _L(spark, sf_dir)
    top = merchants.top_merchants(merchants.top_merchants_by_revenue(L.merchants, L.transactions, L.settlements, 10))
    # The labels that the dashboard's table shows.
    return top.withColumnsRenamed({
        "merchant_name": "Merchant", "category": "Category", "risk_tier": "Risk Tier",
        "total_revenue": "Revenue (EUR)",
    })


@query("p11_list_membership_filter", """
SELECT transaction_id, merchant_id FROM transactions
WHERE transaction_type IN ('purchase', 'refund') AND merchant_id IS NOT NULL AND status = 'completed'
""")
def p11(spark, sf_dir):
    """Type in a set and key present: the transactions eligible for settlement."""
    t = _L(spark, sf_dir).transactions
    return t.where(
        F.col("transaction_type").isin("purchase", "refund") & F.col("merchant_id").isNotNull()
        & (F.col("status") == "completed")
    ).select("transaction_id", "merchant_id")


# ---- joins -------------------------------------------------------------------

@query("j1_inner_equi", """
SELECT t.transaction_id, t.account_id, a.customer_id FROM transactions t JOIN accounts a ON t.account_id = a.account_id
""")
def j1(spark, sf_dir):
    """Fact to dimension on one key."""
    L = _L(spark, sf_dir)
    return L.transactions.select("transaction_id", "account_id").join(
        L.accounts.select("account_id", "customer_id"), "account_id"
    ).select("transaction_id", "account_id", "customer_id")


@query("j2_inner_chain", """
SELECT t.transaction_id, s.settlement_id, m.merchant_id, m.category
FROM merchants m JOIN transactions t ON m.merchant_id = t.merchant_id
JOIN settlements s ON t.transaction_id = s.transaction_id
WHERE t.status = 'completed'
""")
def j2(spark, sf_dir):
    """Three-table chain."""
    L = _L(spark, sf_dir)
    t = completed(L.transactions).select("transaction_id", "merchant_id")
    return (
        t.join(L.settlements.select("transaction_id", "settlement_id"), "transaction_id")
        .join(L.merchants.select("merchant_id", "category"), "merchant_id")
        .select("transaction_id", "settlement_id", "merchant_id", "category")
    )


@query("j3_left_outer", """
SELECT t.transaction_id, f.flag_id, f.flag_reason
FROM transactions t LEFT JOIN fraud_flags f ON t.transaction_id = f.transaction_id
""")
def j3(spark, sf_dir):
    """Keep unflagged transactions (NULL flag columns)."""
    L = _L(spark, sf_dir)
    return L.transactions.select("transaction_id").join(
        L.fraud_flags.select("transaction_id", "flag_id", "flag_reason"), "transaction_id", "left"
    )


@query("j4_aggregate_to_aggregate", f"""
WITH {MERCHANT_FLAGS}
SELECT merchant_id, category, n_tx AS merchant_transactions, pool_tx AS category_transactions FROM pooled
""")
def j4(spark, sf_dir):
    """A group result joined to a coarser group result."""
    m = _merchant_metrics(_L(spark, sf_dir))
    return m.join(risk.category_benchmark(m), "category").select(
        "merchant_id", "category", F.col("total_transactions").alias("merchant_transactions"),
        F.col("cat_total").alias("category_transactions"),
    )


@query("j5_lookup", """
SELECT t.transaction_id, m.risk_tier FROM transactions t JOIN merchants m ON t.merchant_id = m.merchant_id
""")
def j5(spark, sf_dir):
    """Lookup in a dimension: no hint; Spark broadcasts it only if its measured bytes allow."""
    L = _L(spark, sf_dir)
    dim = L.merchants.select("merchant_id", "risk_tier")
    return L.transactions.select("transaction_id", "merchant_id").join(dim, "merchant_id").select(
        "transaction_id", "risk_tier"
    )


@query("j6_null_key", """
SELECT t.transaction_type, COUNT(*) AS joined_rows
FROM transactions t JOIN merchants m ON t.merchant_id = m.merchant_id
GROUP BY t.transaction_type
""")
def j6(spark, sf_dir):
    """A NULL merchant never matches: transfers are absent after the join."""
    L = _L(spark, sf_dir)
    per = L.transactions.groupBy("merchant_id", "transaction_type").agg(F.count(F.lit(1)).alias("n"))
    return (
        per.join(L.merchants.select("merchant_id"), "merchant_id")
        .groupBy("transaction_type").agg(F.sum("n").alias("joined_rows"))
    )


# ---- aggregations ------------------------------------------------------------

@query("a1_count_non_null", """
SELECT transaction_type, COUNT(*) AS row_count, COUNT(merchant_id) AS with_merchant
FROM transactions GROUP BY transaction_type
""")
def a1(spark, sf_dir):
    """COUNT(col) skips NULLs."""
    return _L(spark, sf_dir).transactions.groupBy("transaction_type").agg(
        F.count(F.lit(1)).alias("row_count"), F.count("merchant_id").alias("with_merchant")
    )


@query("a2_sum_decimal", "SELECT currency, CAST(SUM(amount) AS DOUBLE) AS total_amount FROM transactions GROUP BY currency")
def a2(spark, sf_dir):
    """Exact decimal sum per currency."""
    return _L(spark, sf_dir).transactions.groupBy("currency").agg(F.sum("amount").alias("total_amount"))


@query("a3_avg_rounded", f"""
SELECT transaction_type, {rr("SUM(amount) * 100", "COUNT(amount)", 0)} / 100 AS avg_amount
FROM transactions GROUP BY transaction_type
""")
def a3(spark, sf_dir):
    """Mean at 2 digits without double rounding."""
    t = _L(spark, sf_dir).transactions
    g = t.groupBy("transaction_type").agg(F.sum("amount").alias("s"), F.count("amount").alias("n"))
    return g.select("transaction_type", N.mean_money("s", "n").alias("avg_amount"))


@query("a4_min_max", """
SELECT status, MIN(transaction_date) AS first_transaction, MAX(transaction_date) AS last_transaction
FROM transactions GROUP BY status
""")
def a4(spark, sf_dir):
    """First and last timestamp per status."""
    return _L(spark, sf_dir).transactions.groupBy("status").agg(
        F.min("transaction_date").alias("first_transaction"), F.max("transaction_date").alias("last_transaction")
    )


@query("a5_count_distinct", """
SELECT CAST(date_trunc('month', t.transaction_date) AS DATE) AS activity_month,
       COUNT(DISTINCT a.customer_id) AS active_customers
FROM transactions t JOIN accounts a ON t.account_id = a.account_id
WHERE t.status = 'completed'
GROUP BY 1
""")
def a5(spark, sf_dir):
    """Exact distinct customers per month (distinct account-months first)."""
    L = _L(spark, sf_dir)
    am = completed(L.transactions).select("account_id", T.month_start("transaction_date").alias("activity_month")).distinct()
    return (
        am.join(L.accounts.select("account_id", "customer_id"), "account_id")
        .groupBy("activity_month").agg(F.countDistinct("customer_id").alias("active_customers"))
    )


@query("a6_global_agg_coalesce", """
SELECT COUNT(transaction_id) AS total_tx_count,
       COALESCE(CAST(SUM(amount) AS DOUBLE), 0.0) AS total_tx_volume,
       COALESCE(CAST(SUM(amount) AS DOUBLE) / NULLIF(COUNT(transaction_id), 0), 0.0) AS avg_tx_value
FROM transactions WHERE status = 'completed' AND amount <= 0
""")
def a6(spark, sf_dir):
    """A global aggregate over an empty selection still yields one row of zeros."""
    t = _L(spark, sf_dir).transactions.where(F.col("amount") <= 0)
    return trends.overview_kpis(t)


@query("a7_multi_key_group", """
SELECT m.category, m.risk_tier, t.transaction_type, t.status,
       COUNT(*) AS transaction_count, CAST(SUM(t.amount) AS DOUBLE) AS total_amount
FROM transactions t JOIN merchants m ON t.merchant_id = m.merchant_id
GROUP BY m.category, m.risk_tier, t.transaction_type, t.status
""")
def a7(spark, sf_dir):
    """Four grouping keys across a join (per-merchant partial groups first)."""
    L = _L(spark, sf_dir)
    per = L.transactions.groupBy("merchant_id", "transaction_type", "status").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("s")
    )
    return (
        per.join(L.merchants.select("merchant_id", "category", "risk_tier"), "merchant_id")
        .groupBy("category", "risk_tier", "transaction_type", "status")
        .agg(F.sum("n").alias("transaction_count"), F.sum("s").cast("decimal(25,2)").alias("total_amount"))
    )


@query("a8_ratio_of_sums", f"""
WITH {MERCHANT_FLAGS}
SELECT DISTINCT category, pool_flagged AS cat_flagged, pool_tx AS cat_total,
       {rr("pool_flagged", "pool_tx", 4)} AS category_avg_fraud_rate
FROM pooled
""")
def a8(spark, sf_dir):
    """Pooled rate: sum of flags over sum of transactions, per category."""
    b = risk.category_benchmark(_merchant_metrics(_L(spark, sf_dir)))
    return b.select("category", "cat_flagged", "cat_total",
                    N.round_ratio("cat_flagged", "cat_total", 4).alias("category_avg_fraud_rate"))


@query("a9_mean_duration", f"""
SELECT flag_reason, COUNT(*) AS resolved_flags,
       {rr("SUM(epoch_us(resolved_date) - epoch_us(flagged_date))", "COUNT(*) * 3600000000", 2)} AS avg_hours_to_resolve
FROM fraud_flags WHERE is_resolved GROUP BY flag_reason
""")
def a9(spark, sf_dir):
    """Mean of a time difference: hours from flag to resolution per reason."""
    f = _L(spark, sf_dir).fraud_flags.where(F.col("is_resolved"))
    g = f.groupBy("flag_reason").agg(
        F.count(F.lit(1)).alias("resolved_flags"),
        F.sum(F.timestamp_diff("MICROSECOND", F.col("flagged_date"), F.col("resolved_date")).cast("decimal(20,0)")).alias("us"),
    )
    return g.select("flag_reason", "resolved_flags",
                    N.round_ratio("us", F.col("resolved_flags") * 3_600_000_000, 2).alias("avg_hours_to_resolve"))


# ---- windows -----------------------------------------------------------------

@query("w1_rank", f"""
WITH {EARNED},
placed AS (SELECT merchant_id, category, revenue FROM earned JOIN merchants USING (merchant_id))
SELECT merchant_id, category, CAST(revenue AS DOUBLE) AS total_revenue,
       1 + (SELECT count(*) FROM placed more WHERE more.category = placed.category AND more.revenue > placed.revenue)
         AS category_revenue_rank
FROM placed
""")
def w1(spark, sf_dir):
    """RANK with gaps inside each category, for every merchant."""
    L = _L(spark, sf_dir)
    rev = merchants.merchant_settled_revenue(L.merchants, L.transactions, L.settlements, merchant_cols=("category",))
    return merchants.rank_within(rev, "category", "total_revenue", "category_revenue_rank")


@query("w2_lag_partitioned", f"""
WITH {COHORTS}
SELECT joined AS cohort_month, months AS months_active_offset, n AS active_customers,
       lag(n) OVER (PARTITION BY joined ORDER BY months) AS prev_month_active_customers
FROM cohorts
""")
def w2(spark, sf_dir):
    """LAG inside a partition: previous observed offset's active count."""
    L = _L(spark, sf_dir)
    counts = cohort.cohort_retention_counts(L.customers, L.accounts, L.transactions)
    w = Window.partitionBy("cohort_month").orderBy("months_active_offset")
    return counts.withColumn("prev_month_active_customers", F.lag("active_customers").over(w))


def _daily_window(key: str, col: str):
    @query(key, f"WITH {SERIES} SELECT transaction_date, daily_amount, {col} FROM series")
    def build(spark, sf_dir):
        q7 = rolling.rolling_metrics(_L(spark, sf_dir).transactions)
        return q7.select("transaction_date", "daily_amount", col)

    build.__doc__ = f"Daily series: {col}."
    return build


_daily_window("w3_lag_global", "prev_day_amount")
_daily_window("w4_lead_global", "next_day_amount")
_daily_window("w5_moving_avg_7", "rolling_avg_7d")
_daily_window("w6_moving_avg_30", "rolling_avg_30d")
_daily_window("w7_moving_sum_30", "rolling_sum_30d")
_daily_window("w8_period_change", "day_over_day_change")


# ---- sorts and top-k ---------------------------------------------------------

@query("o1_sort_asc_desc", """
SELECT country, COUNT(customer_id) AS customer_count FROM customers GROUP BY country ORDER BY customer_count DESC, country
""")
def o1(spark, sf_dir):
    """One descending key (name breaks ties)."""
    c = _L(spark, sf_dir).customers
    return c.groupBy("country").agg(F.count("customer_id").alias("customer_count")).orderBy(
        *sort_keys("-customer_count", "country"))


@query("o2_sort_multi", """
SELECT status, transaction_type, COUNT(*) AS transaction_count FROM transactions
GROUP BY status, transaction_type ORDER BY status ASC, transaction_count DESC
""")
def o2(spark, sf_dir):
    """Two keys, ascending then descending."""
    t = _L(spark, sf_dir).transactions
    return t.groupBy("status", "transaction_type").agg(F.count(F.lit(1)).alias("transaction_count")).orderBy(
        *sort_keys("status", "-transaction_count"))


@query("o3_top_k", """
SELECT transaction_id, CAST(amount AS DOUBLE) AS amount FROM transactions WHERE status = 'completed'
ORDER BY transactions.amount DESC, transaction_id LIMIT 10
""")
def o3(spark, sf_dir):
    """ORDER BY + LIMIT with the id as the last key (TakeOrderedAndProject)."""
    t = completed(_L(spark, sf_dir).transactions)
    return t.orderBy(*sort_keys("-amount", "transaction_id")).limit(10).select("transaction_id", "amount")


# ---- scalar functions and reshaping -------------------------------------------

@query("f1_trunc_month", "SELECT transaction_id, CAST(date_trunc('month', transaction_date) AS DATE) AS transaction_month FROM transactions")
def f1(spark, sf_dir):
    """Month start as DATE."""
    return _L(spark, sf_dir).transactions.select("transaction_id", T.month_start("transaction_date").alias("transaction_month"))


@query("f2_trunc_day", "SELECT transaction_id, CAST(transaction_date AS DATE) AS transaction_day FROM transactions")
def f2(spark, sf_dir):
    """Calendar day as DATE."""
    return _L(spark, sf_dir).transactions.select("transaction_id", T.day_of("transaction_date").alias("transaction_day"))


SETTLE_JOIN = "FROM settlements s JOIN transactions t ON s.transaction_id = t.transaction_id"


def _settle(L):
    return L.settlements.join(L.transactions.select("transaction_id", "transaction_date", "amount"), "transaction_id")


@query("f3_timestamp_diff", f"""
SELECT s.settlement_id, CAST(epoch(s.settlement_date) - epoch(t.transaction_date) AS BIGINT) AS settle_seconds {SETTLE_JOIN}
""")
def f3(spark, sf_dir):
    """Seconds between two timestamps."""
    return _settle(_L(spark, sf_dir)).select(
        "settlement_id", T.seconds_between("transaction_date", "settlement_date").alias("settle_seconds"))


@query("f4_epoch_days", f"""
SELECT s.settlement_id, CAST(epoch(s.settlement_date) - epoch(t.transaction_date) AS DOUBLE) / 86400.0 AS settle_days
{SETTLE_JOIN}
""")
def f4(spark, sf_dir):
    """Epoch difference in days (seconds / 86400)."""
    return _settle(_L(spark, sf_dir)).select(
        "settlement_id",
        (T.seconds_between("transaction_date", "settlement_date").cast("double") / F.lit(86400.0)).alias("settle_days"))


@query("f5_age_months", f"""
SELECT a.customer_id, {age_months_sql("MAX(t.transaction_date)", "MIN(t.transaction_date)")} AS whole_months
FROM transactions t JOIN accounts a ON t.account_id = a.account_id
WHERE t.status = 'completed'
GROUP BY a.customer_id
""")
def f5(spark, sf_dir):
    """Whole months between first and last completed transaction (AGE)."""
    L = _L(spark, sf_dir)
    act = lifetime.customer_activity(L.accounts, L.transactions)
    return act.select("customer_id", T.age_months("last_transaction", "first_transaction").alias("whole_months"))


@query("f6_round", f"""
SELECT s.settlement_id, {rr("s.processing_fee * 100", "t.amount * 100", 4)} AS fee_rate {SETTLE_JOIN}
""")
def f6(spark, sf_dir):
    """ROUND(fee / amount, 4), half away from zero on the exact ratio."""
    return _settle(_L(spark, sf_dir)).select(
        "settlement_id", N.round_ratio(N.cents("processing_fee"), N.cents("amount"), 4).alias("fee_rate"))


@query("f7_cast", """
SELECT transaction_id, CAST(transaction_date AS DATE) AS tx_date, CAST(amount * 100 AS BIGINT) AS amount_cents,
       CAST(account_id AS VARCHAR) AS account_text
FROM transactions
""")
def f7(spark, sf_dir):
    """Casts: timestamp to DATE, exact decimal to integer cents, key to text."""
    return _L(spark, sf_dir).transactions.select(
        "transaction_id", F.col("transaction_date").cast("date").alias("tx_date"),
        (F.col("amount") * 100).cast("long").alias("amount_cents"),
        F.col("account_id").cast("string").alias("account_text"))


@query("f8_greatest", f"""
WITH {SPENT}
SELECT customer_id, months AS months_active FROM spent
""")
def f8(spark, sf_dir):
    """GREATEST(1, months): a floor of one month."""
    L = _L(spark, sf_dir)
    act = lifetime.customer_activity(L.accounts, L.transactions)
    return act.join(L.customers.select("customer_id"), "customer_id").select("customer_id", "months_active")


@query("f9_coalesce", """
WITH rev AS (
  SELECT t.merchant_id, SUM(s.settled_amount) AS total_revenue
  FROM transactions t JOIN settlements s ON t.transaction_id = s.transaction_id
  WHERE t.status = 'completed' GROUP BY t.merchant_id
)
SELECT m.merchant_id, CAST(COALESCE(r.total_revenue, 0) AS DOUBLE) AS total_revenue
FROM merchants m LEFT JOIN rev r ON m.merchant_id = r.merchant_id
""")
def f9(spark, sf_dir):
    """NULL to 0 for merchants without settled revenue."""
    L = _L(spark, sf_dir)
    rev = merchants.merchant_settled_revenue(L.merchants, L.transactions, L.settlements, merchant_cols=())
    return L.merchants.select("merchant_id").join(rev, "merchant_id", "left").select(
        "merchant_id", F.coalesce("total_revenue", F.lit(0)).alias("total_revenue"))


@query("f10_ratio_percent", f"""
SELECT status, COUNT(*) AS transaction_count,
       {rr("COUNT(*) * 100", "(SELECT COUNT(*) FROM transactions)", 2)} AS share_pct
FROM transactions GROUP BY status
""")
def f10(spark, sf_dir):
    """a / b * 100 at 2 digits: each status's share of all transactions."""
    g = _L(spark, sf_dir).transactions.groupBy("status").agg(F.count(F.lit(1)).alias("transaction_count"))
    total = F.sum("transaction_count").over(Window.partitionBy())  # over the few status rows
    return g.select("status", "transaction_count", N.round_ratio_percent("transaction_count", total, 2).alias("share_pct"))


@query("f11_spend_per_month", f"""
WITH {SPENT}
SELECT customer_id, {rr("spend * 100", "months", 0)} / 100 AS revenue_per_month FROM spent
""")
def f11(spark, sf_dir):
    """Spend per active month at 2 digits, every customer."""
    L = _L(spark, sf_dir)
    clv = lifetime.customer_lifetime_value(L.customers, L.accounts, L.transactions, k=None)
    return clv.select("customer_id", "revenue_per_month")


@query("f12_pivot", """
SELECT CAST(year(transaction_date) AS BIGINT) AS transaction_year,
       COUNT(*) FILTER (WHERE transaction_type = 'purchase') AS purchase,
       COUNT(*) FILTER (WHERE transaction_type = 'refund') AS refund,
       COUNT(*) FILTER (WHERE transaction_type = 'transfer') AS transfer
FROM transactions WHERE status = 'completed' GROUP BY 1
""")
def f12(spark, sf_dir):
    """Long to wide with an explicit value list: completed counts per year and type."""
    t = completed(_L(spark, sf_dir).transactions)
    types = ["purchase", "refund", "transfer"]
    wide = t.groupBy(F.year("transaction_date").alias("transaction_year")).pivot("transaction_type", types).agg(
        F.count(F.lit(1)))
    return wide.select("transaction_year", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in types])


@query("f13_year_month_label", """
SELECT strftime(transaction_date, '%Y-%m') AS month_label, COUNT(*) AS transaction_count
FROM transactions WHERE status = 'completed' GROUP BY 1
""")
def f13(spark, sf_dir):
    """``yyyy-MM`` labels."""
    t = completed(_L(spark, sf_dir).transactions)
    return t.groupBy(T.year_month_label("transaction_date").alias("month_label")).agg(
        F.count(F.lit(1)).alias("transaction_count"))


def _fixed2_sql(units: str) -> str:
    return f"(format('{{:,}}', CAST(({units}) // 100 AS BIGINT)) || '.' || lpad(CAST(CAST(({units}) % 100 AS BIGINT) AS VARCHAR), 2, '0'))"


@query("f14_number_labels", f"""
WITH cat AS (
  SELECT m.category, COUNT(t.transaction_id) AS n, COUNT(f.flag_id) AS flagged,
         COUNT(t.transaction_id) FILTER (WHERE m.risk_tier = 'high') AS n_high,
         COUNT(f.flag_id) FILTER (WHERE m.risk_tier = 'high') AS flagged_high
  FROM transactions t JOIN merchants m ON t.merchant_id = m.merchant_id
  LEFT JOIN fraud_flags f ON t.transaction_id = f.transaction_id
  GROUP BY m.category
),
rev AS (
  SELECT m.category, CAST(SUM(s.settled_amount) * 100 AS HUGEINT) AS cents
  FROM merchants m JOIN transactions t ON m.merchant_id = t.merchant_id
  JOIN settlements s ON t.transaction_id = s.transaction_id
  WHERE t.status = 'completed' GROUP BY m.category
),
u AS (
  SELECT c.category, c.n, r.cents,
         CAST((2 * CAST(c.flagged AS HUGEINT) * 10000 + c.n) // (2 * c.n) AS HUGEINT) AS rate_units,
         CASE WHEN c.n_high > 0 THEN CAST((2 * CAST(c.flagged_high AS HUGEINT) * 10000 + c.n_high) // (2 * c.n_high) AS HUGEINT) END AS high_units
  FROM cat c LEFT JOIN rev r ON c.category = r.category
)
SELECT category,
       format('{{:,}}', n) AS transactions_label,
       COALESCE('€' || {_fixed2_sql("cents")}, '-') AS revenue_label,
       COALESCE({_fixed2_sql("rate_units")} || '%', '-') AS fraud_rate_label,
       COALESCE({_fixed2_sql("high_units")} || '%', '-') AS high_tier_rate_label
FROM u
""")
def f14(spark, sf_dir):
    """Display labels: ``1,234``, ``€1,234.50``, ``12.30%`` and ``-`` for NULL."""
    L = _L(spark, sf_dir)
    counts = risk.merchant_activity(L.transactions, L.fraud_flags, L.settlements).join(
        L.merchants.select("merchant_id", "category", "risk_tier"), "merchant_id")
    high = F.col("risk_tier") == "high"
    j = counts.groupBy("category").agg(
        F.sum("total_transactions").alias("n"), F.sum("flagged_transactions").alias("flagged"),
        F.sum(F.when(high, F.col("total_transactions")).otherwise(0)).alias("n_high"),
        F.sum(F.when(high, F.col("flagged_transactions")).otherwise(0)).alias("flagged_high"), F.sum("total_revenue").alias("rev"),
    )
    return j.select(
        "category",
        X.thousands("n").alias("transactions_label"),
        X.money_label(N.cents("rev")).alias("revenue_label"),
        X.percent_label(N.ratio_units(F.col("flagged") * 100, "n", 2)).alias("fraud_rate_label"),
        X.percent_label(F.when(F.col("n_high") > 0, N.ratio_units(F.col("flagged_high") * 100, "n_high", 2))
                        ).alias("high_tier_rate_label"),
    )


@query("f15_email_from_name", """
SELECT customer_id, regexp_replace(lower(full_name), '[ .]', '', 'g') || '_' || CAST(customer_id AS VARCHAR) || '@example.com' AS generated_email
FROM customers
""")
def f15(spark, sf_dir):
    """Generator e-mail rule: lower case, no spaces or dots, ``_id@example.com``."""
    c = _L(spark, sf_dir).customers
    return c.select("customer_id", X.email_from_name("full_name", "customer_id").alias("generated_email"))


@query("f16_parse_temporal", """
SELECT transaction_id,
       strptime(strftime(transaction_date, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS parsed_ts,
       CAST(strptime(strftime(transaction_date, '%Y-%m-%d'), '%Y-%m-%d') AS DATE) AS parsed_date
FROM transactions
""")
def f16(spark, sf_dir):
    """Text back to TIMESTAMP and DATE (round trip through the CSV formats)."""
    t = _L(spark, sf_dir).transactions
    return t.select(
        "transaction_id",
        T.parse_timestamp(T.format_timestamp("transaction_date")).alias("parsed_ts"),
        T.parse_date(F.date_format("transaction_date", "yyyy-MM-dd")).alias("parsed_date"))


@query("f17_add_duration", """
SELECT flag_id, flagged_date + INTERVAL 7 DAY + INTERVAL 12 HOUR + INTERVAL 30 MINUTE AS review_due FROM fraud_flags
""")
def f17(spark, sf_dir):
    """Timestamp plus days, hours and minutes."""
    f = _L(spark, sf_dir).fraud_flags
    return f.select("flag_id", T.add_seconds("flagged_date", F.lit(7 * 86400 + 12 * 3600 + 30 * 60)).alias("review_due"))


@query("f18_format_temporal", """
SELECT transaction_id, strftime(transaction_date, '%Y-%m-%d %H:%M:%S') AS transaction_text FROM transactions
""")
def f18(spark, sf_dir):
    """Timestamp to ``yyyy-MM-dd HH:mm:ss`` text."""
    t = _L(spark, sf_dir).transactions
    return t.select("transaction_id", T.format_timestamp("transaction_date").alias("transaction_text"))


FEE_BANDS_BP = rules.FEE_BANDS_BP


@query("f19_case_by_tier", """
SELECT merchant_id, risk_tier,
       CAST(CASE risk_tier WHEN 'high' THEN 350 WHEN 'medium' THEN 200 ELSE 100 END AS BIGINT) AS fee_floor_bp,
       CAST(CASE risk_tier WHEN 'high' THEN 500 WHEN 'medium' THEN 300 ELSE 180 END AS BIGINT) AS fee_cap_bp
FROM merchants
""")
def f19(spark, sf_dir):
    """Value by risk tier (CASE WHEN)."""
    m = _L(spark, sf_dir).merchants
    tier = F.col("risk_tier")

    def band(i):
        return (F.when(tier == "high", FEE_BANDS_BP["high"][i]).when(tier == "medium", FEE_BANDS_BP["medium"][i])
                .otherwise(FEE_BANDS_BP["low"][i]))

    return m.select("merchant_id", "risk_tier", band(0).alias("fee_floor_bp"), band(1).alias("fee_cap_bp"))


@query("f20_clip_floor", f"""
SELECT s.settlement_id, CAST(greatest(t.amount - s.processing_fee, 0) AS DOUBLE) AS net_amount {SETTLE_JOIN}
""")
def f20(spark, sf_dir):
    """Not below zero: GREATEST(amount - fee, 0)."""
    s = _settle(_L(spark, sf_dir))
    return s.select("settlement_id", F.greatest(F.col("amount") - F.col("processing_fee"), F.lit(0)).alias("net_amount"))
