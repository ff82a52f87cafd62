"""Operator semantics on hand-made ledgers (FIXTURES.md section 5)."""

import datetime as dt
import random
from collections import Counter
from decimal import Decimal

import pytest

from ledgerlens.operators import cohort, lifetime, merchants, risk, rolling, segments, trends
from ledgerlens.sources.schemas import SCHEMAS


def D(x):
    return Decimal(str(x)).quantize(Decimal("0.01"))


def T(s):
    return dt.datetime.fromisoformat(s)


def frame(spark, table, rows):
    return spark.createDataFrame(rows, SCHEMAS[table])


def tx(tid, acct, merchant, amount, when, ttype="purchase", status="completed", cur="EUR"):
    return (tid, acct, merchant, D(amount), cur, T(when), ttype, status)


def merchant(mid, category="Retail", tier="low"):
    return (mid, f"m{mid}", category, "X", dt.date(2020, 1, 1), tier)


def customer(cid, joined="2024-01-10", segment="retail", country="X"):
    return (cid, f"c{cid}", f"c{cid}@x", country, dt.date.fromisoformat(joined), segment, True)


def account(aid, cid):
    return (aid, cid, "current", "EUR", dt.date(2020, 1, 1), "active")


def test_rolling_frames_count_observed_days_not_calendar_days(spark):
    t = frame(spark, "transactions", [
        tx(1, 1, None, 10, "2024-01-01 10:00", "transfer"),
        tx(2, 1, None, 20, "2024-01-02 10:00", "transfer"),
        tx(3, 1, None, 30, "2024-01-10 10:00", "transfer"),
    ])
    rows = rolling.rolling_metrics(t).collect()
    assert [r.rolling_avg_7d for r in rows] == [10.0, 15.0, 20.0]  # day 10 uses all three rows
    assert rows[0].prev_day_amount is None and rows[0].day_over_day_change is None
    assert rows[2].prev_day_amount == D(20) and rows[2].day_over_day_change == D(10)
    assert rows[0].next_day_amount == D(20) and rows[2].next_day_amount is None
    assert rows[2].rolling_sum_30d == D(60)


def test_rolling_partition_cols_gives_independent_series(spark):
    t = frame(spark, "transactions", [
        tx(1, 1, None, 10, "2024-01-01 10:00", cur="EUR"),
        tx(2, 1, None, 20, "2024-01-02 10:00", cur="GBP"),
        tx(3, 1, None, 30, "2024-01-03 10:00", cur="EUR"),
    ])
    rows = rolling.rolling_metrics(t, partition_cols=("currency",)).collect()
    eur = [r for r in rows if r.currency == "EUR"]
    assert [r.rolling_avg_7d for r in eur] == [10.0, 20.0]
    assert eur[1].prev_day_amount == D(10)


def test_rank_has_gaps_on_ties(spark):
    m = frame(spark, "merchants", [merchant(1), merchant(2), merchant(3)])
    t = frame(spark, "transactions", [tx(i, 1, i, 100, "2024-01-01 00:00") for i in (1, 2, 3)])
    s = spark.createDataFrame(
        [(i, i, T("2024-01-03 00:00"), D(a), D(0), "settled") for i, a in ((1, 100), (2, 100), (3, 90))],
        SCHEMAS["settlements"])
    rev = merchants.merchant_settled_revenue(m, t, s)
    top = merchants.top_merchants_by_revenue(m, t, s, 20)
    ranks = {r.merchant_id: r.category_revenue_rank for r in merchants.top_merchants_with_rank(top).collect()}
    assert ranks == {1: 1, 2: 1, 3: 3}
    full = {r.merchant_id: r.rank for r in merchants.rank_within(rev, "category", "total_revenue").collect()}
    assert full == {1: 1, 2: 1, 3: 3}


def test_top_k_rank_is_rank_over_all_merchants(spark):
    # The in-category rank of the top-k merchants comes from the k rows alone.
    m = frame(spark, "merchants", [merchant(1, "A"), merchant(2, "A"), merchant(3, "B"), merchant(4, "B")])
    amounts = {1: 500, 2: 100, 3: 400, 4: 300}
    t = frame(spark, "transactions", [tx(i, 1, i, a, "2024-01-01 00:00") for i, a in amounts.items()])
    s = spark.createDataFrame([(i, i, T("2024-01-03 00:00"), D(a), D(0), "settled") for i, a in amounts.items()],
                              SCHEMAS["settlements"])
    top = merchants.top_merchants_with_rank(merchants.top_merchants_by_revenue(m, t, s, 3)).collect()
    assert [(r.merchant_id, r.category_revenue_rank) for r in top] == [(1, 1), (3, 1), (4, 2)]


def test_null_merchant_is_absent_from_merchant_queries(spark):
    m = frame(spark, "merchants", [merchant(1)])
    t = frame(spark, "transactions", [
        tx(1, 1, 1, 100, "2024-01-01 00:00"),
        tx(2, 1, None, 50, "2024-01-01 00:00", "transfer"),
    ])
    f = spark.createDataFrame([], SCHEMAS["fraud_flags"])
    by_cat = risk.fraud_rate_by(t, m, f).collect()
    assert [(r.category, r.total_transactions) for r in by_cat] == [("Retail", 1)]
    monthly = trends.monthly_trends(t).collect()
    assert monthly[0].transaction_volume == 2  # transfers stay in the trends


def test_overview_on_empty_input_is_one_row_of_zeros(spark):
    t = frame(spark, "transactions", [tx(1, 1, None, 10, "2024-01-01 00:00", "transfer", "failed")])
    row = trends.overview_kpis(t).collect()
    assert len(row) == 1 and tuple(row[0]) == (0, 0.0, 0.0)


def _flags(spark, tids):
    return spark.createDataFrame(
        [(i, i, T("2024-01-01 01:00"), "Velocity Limit Exceeded", False, None) for i in tids], SCHEMAS["fraud_flags"])


def test_benchmark_equality_is_excluded(spark):
    # Every merchant: 2 flagged of 20 -> equal to the pooled rate -> empty.
    m = frame(spark, "merchants", [merchant(1), merchant(2)])
    rows, flagged = [], []
    for mid in (1, 2):
        for j in range(20):
            tid = mid * 100 + j
            rows.append(tx(tid, 1, mid, 10, "2024-01-01 00:00"))
            if j < 2:
                flagged.append(tid)
    out = risk.risk_indicators(frame(spark, "transactions", rows), m, _flags(spark, flagged)).collect()
    assert out == []


def test_minimum_transactions_threshold(spark):
    m = frame(spark, "merchants", [merchant(1), merchant(2), merchant(3)])
    rows, flagged = [], []
    for mid, n, nf in ((1, 19, 5), (2, 20, 5), (3, 100, 0)):
        for j in range(n):
            tid = mid * 1000 + j
            rows.append(tx(tid, 1, mid, 10, "2024-01-01 00:00"))
            if j < nf:
                flagged.append(tid)
    out = risk.risk_indicators(frame(spark, "transactions", rows), m, _flags(spark, flagged)).collect()
    assert [r.merchant_id for r in out] == [2]  # 19 excluded, 20 included
    assert out[0].merchant_fraud_rate == 0.25
    assert out[0].category_avg_fraud_rate == round(10 / 139, 4)


def test_customer_threshold_is_strictly_more_than_ten(spark):
    rows = [customer(i, country="A") for i in range(10)] + [customer(100 + i, country="B") for i in range(11)]
    out = segments.customer_segments(frame(spark, "customers", rows)).collect()
    assert [(r.country, r.customer_count) for r in out] == [("B", 11)]


def test_sparse_cohort_offsets_lag_previous_observed(spark):
    c = frame(spark, "customers", [customer(1, "2024-01-10"), customer(2, "2024-01-20")])
    a = frame(spark, "accounts", [account(1, 1), account(2, 2)])
    t = frame(spark, "transactions", [
        tx(1, 1, None, 10, "2024-01-15 00:00", "transfer"),
        tx(2, 1, None, 10, "2024-04-15 00:00", "transfer"),
        tx(3, 2, None, 10, "2024-04-16 00:00", "transfer"),
    ])
    rows = cohort.cohort_analysis(c, a, t).collect()
    assert [(r.months_active_offset, r.active_customers, r.prev_month_active_customers) for r in rows] == [
        (0, 1, None), (3, 2, 1)]
    assert [r.retention_rate for r in rows] == [0.5, 1.0]
    assert all(r.cohort_size == 2 for r in rows)


def test_activity_over_several_calendar_words(spark):
    """Months on both sides of word boundaries, before joining, 190 months apart; against sets in Python."""
    rng = random.Random(7)
    joins = {c: f"{2003 + c % 9}-{1 + c % 12:02d}-{1 + c % 28:02d}" for c in range(30)}
    c = frame(spark, "customers", [customer(k, d) for k, d in joins.items()])
    a = frame(spark, "accounts", [account(k, k // 2) for k in range(60)])
    days = [(rng.randrange(60), rng.randrange(2001, 2017), rng.randrange(1, 13), rng.randrange(1, 29)) for _ in range(900)]
    days += [(0, y, m, 1) for y, m in ((2005, 4), (2005, 5), (2010, 8), (2010, 9))] + [(1, 2005, 5, 31), (1, 2010, 8, 31)]
    t = frame(spark, "transactions", [tx(n, k, None, 10, f"{y}-{m:02d}-{d:02d} 23:59", "transfer") for n, (k, y, m, d) in enumerate(days)])
    active = {(k // 2, y * 12 + m) for k, y, m, _ in days}
    joined = {k: int(d[:4]) * 12 + int(d[5:7]) for k, d in joins.items()}
    got = cohort.monthly_active_customers(c, a, t).collect()
    assert len(got) == len(active) and {(r.customer_id, r.activity_month.year * 12 + r.activity_month.month) for r in got} == active
    assert all(r.activity_month.day == 1 for r in got)
    want = Counter((joined[k], month - joined[k]) for k, month in active)
    got = cohort.cohort_retention_counts(c, a, t).collect()
    assert {(r.cohort_month.year * 12 + r.cohort_month.month, r.months_active_offset): r.active_customers for r in got} == want
    assert len(got) == len(want) and min(o for _, o in want) < 0 and max(o for _, o in want) > 64
    for offset in (3, 61, 64, 100):
        hits = sum(r.active_customers for r in cohort.retention_at_offset_by_segment(c, a, t, offset=offset).collect())
        assert hits == sum(n for (_, o), n in want.items() if o == offset)


def test_cohort_matrix_has_null_where_absent(spark):
    c = frame(spark, "customers", [customer(1, "2024-01-10")])
    a = frame(spark, "accounts", [account(1, 1)])
    t = frame(spark, "transactions", [tx(1, 1, None, 10, "2024-03-15 00:00", "transfer")])
    wide = cohort.cohort_matrix(cohort.cohort_retention_pct(c, a, t)).collect()
    assert len(wide) == 1 and wide[0]["cohort_month"] == "2024-01"
    assert wide[0]["2"] == 100.0 and wide[0]["0"] is None and wide[0]["12"] is None


def test_single_transaction_counts_one_month(spark):
    c = frame(spark, "customers", [customer(1)])
    a = frame(spark, "accounts", [account(1, 1), account(2, 1)])
    t = frame(spark, "transactions", [tx(1, 1, None, 10.01, "2024-01-15 00:00", "transfer")])
    row = lifetime.customer_lifetime_value(c, a, t).collect()[0]
    assert row.months_active == 1 and row.revenue_per_month == 10.01 and row.avg_transaction_value == 10.01


def test_lifetime_rolls_accounts_up_to_customer(spark):
    c = frame(spark, "customers", [customer(1)])
    a = frame(spark, "accounts", [account(1, 1), account(2, 1)])
    t = frame(spark, "transactions", [
        tx(1, 1, None, 10, "2024-01-31 10:00", "transfer"),
        tx(2, 2, None, 20, "2024-05-31 09:00", "transfer"),
        tx(3, 2, None, 99, "2024-06-30 09:00", "transfer", "failed"),
    ])
    row = lifetime.customer_lifetime_value(c, a, t).collect()[0]
    assert row.completed_transaction_count == 2
    assert row.customer_lifetime_value == D(30)
    assert row.months_active == 3  # 2024-05-31 09:00 is before the 31st 10:00
    assert row.revenue_per_month == 10.0
    assert row.avg_transaction_value == 15.0


@pytest.mark.parametrize("k", [1, 2])
def test_top_merchants_limit(spark, k):
    m = frame(spark, "merchants", [merchant(1), merchant(2)])
    t = frame(spark, "transactions", [tx(1, 1, 1, 5, "2024-01-01 00:00"), tx(2, 1, 2, 7, "2024-01-01 00:00")])
    s = spark.createDataFrame([(i, i, T("2024-01-03 00:00"), D(a), D(0), "settled") for i, a in ((1, 5), (2, 7))],
                              SCHEMAS["settlements"])
    out = merchants.top_merchants(merchants.top_merchants_by_revenue(m, t, s, k)).collect()
    assert [r.merchant_name for r in out] == ["m2", "m1"][:k]


def test_top_k_lookup_falls_back_when_a_key_has_no_dimension_row(spark):
    # Merchant 9 has the most revenue but no merchant row: the inner join
    # drops it, so the top 2 must be merchants 2 and 1.
    m = frame(spark, "merchants", [merchant(1), merchant(2)])
    amounts = {1: 100, 2: 200, 9: 900}
    t = frame(spark, "transactions", [tx(i, 1, i, a, "2024-01-01 00:00") for i, a in amounts.items()])
    s = spark.createDataFrame([(i, i, T("2024-01-03 00:00"), D(a), D(0), "settled") for i, a in amounts.items()],
                              SCHEMAS["settlements"])
    top = merchants.top_merchants_by_revenue(m, t, s, 2).collect()
    assert [r.merchant_id for r in top] == [2, 1]


def test_top_k_lookup_skips_keys_without_a_dimension_row(spark):
    from ledgerlens.operators.common import sort_keys, top_k_with_lookup

    facts = spark.createDataFrame([(1, 100), (2, 200), (9, 900)], "merchant_id long, total_revenue long")
    dim = spark.createDataFrame([(1, "a"), (2, "b")], "merchant_id long, merchant_name string")
    got = top_k_with_lookup(facts, dim, "merchant_id", sort_keys("-total_revenue", "merchant_id"), 2).collect()
    assert [r.merchant_id for r in got] == [2, 1]
