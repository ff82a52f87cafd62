"""Skewed ledger: one merchant and one account carry a third of all rows.

The operators must give the same answers as the oracle SQL run in DuckDB over
the very same (written) tables.
"""

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import cohort, latency, lifetime, merchants, risk, rules, segments
from ledgerlens.operators.common import report
from ledgerlens.plans.registry import REGISTRY, queries
from ledgerlens.plans.verify import compare
from ledgerlens.sources.ledger import read_ledger
from ledgerlens.sources.schemas import LOAD_ORDER


@pytest.fixture(scope="module")
def skewed(spark, ledger, tmp_path_factory):
    queries()  # load the registry
    path = str(tmp_path_factory.mktemp("skewed"))
    hot_merchant = ledger.merchants.agg(F.min("merchant_id")).first()[0]
    hot_account = ledger.accounts.agg(F.min("account_id")).first()[0]
    hot = (F.col("transaction_id") % 3) == 0
    tx = ledger.transactions.withColumn(
        "merchant_id", F.when(hot & F.col("merchant_id").isNotNull(), F.lit(hot_merchant)).otherwise(F.col("merchant_id"))
    ).withColumn("account_id", F.when(hot, F.lit(hot_account)).otherwise(F.col("account_id")))
    tables = ledger.as_dict()
    tables["transactions"] = tx
    for name in LOAD_ORDER:
        tables[name].write.mode("overwrite").parquet(f"{path}/{name}")
    con = duckdb.connect()
    for name in LOAD_ORDER:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}/{name}/*.parquet')")
    return read_ledger(spark, path), con


CASES = {
    "q3_merchant_performance": lambda L: merchants.top_merchants_with_rank(
        merchants.top_merchants_by_revenue(L.merchants, L.transactions, L.settlements, 20)),
    "q4_settlement_latency": lambda L: latency.settlement_latency(L.settlements, L.transactions, L.merchants),
    "q5_risk_indicators": lambda L: risk.risk_indicators(L.transactions, L.merchants, L.fraud_flags),
    "q6_cohort_analysis": lambda L: cohort.cohort_analysis(L.customers, L.accounts, L.transactions),
    "q8_customer_lifetime_value": lambda L: lifetime.customer_lifetime_value(L.customers, L.accounts, L.transactions),
    "q12_fraud_rate_by_category": lambda L: risk.fraud_rate_by(L.transactions, L.merchants, L.fraud_flags),
    "q13_cohort_retention_12m": lambda L: cohort.cohort_retention_pct(L.customers, L.accounts, L.transactions),
    "k3_volume_share_by_segment": lambda L: segments.volume_share_by_segment(L.customers, L.accounts, L.transactions),
    "r3_fee_band": lambda L: rules.fee_band(L.settlements, L.transactions, L.merchants),
    "r6_currency_match": lambda L: rules.currency_match(L.transactions, L.accounts),
    "w1_rank": lambda L: merchants.rank_within(
        merchants.merchant_settled_revenue(L.merchants, L.transactions, L.settlements, merchant_cols=("category",)),
        "category", "total_revenue", "category_revenue_rank"),
}


@pytest.mark.parametrize("key", sorted(CASES))
def test_skewed_ledger_matches_oracle(skewed, key):
    L, con = skewed
    ok, msg = compare(report(CASES[key](L)), con, REGISTRY[key].oracle)
    assert ok, msg
