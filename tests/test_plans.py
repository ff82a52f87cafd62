"""Plan shape: pushdown, pruning, top-k and where the single-partition windows sit."""

import re

import pytest

from ledgerlens.plans.inspect import plan_text
from ledgerlens.plans.registry import queries
from ledgerlens.sources import files

from .conftest import SF_SMALL


def test_status_filter_is_pushed_into_the_scan(spark):
    text = plan_text(queries()["q2_transaction_trends"](spark, SF_SMALL))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(status,completed\)", text)


def test_scan_reads_only_needed_columns(spark):
    text = plan_text(queries()["q2_transaction_trends"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", text)
    assert schemas and all("merchant_id" not in s and "currency" not in s for s in schemas)


def test_top_k_uses_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan_text(queries()["o3_top_k"](spark, SF_SMALL), "simple")
    assert "TakeOrderedAndProject" in plan_text(queries()["r9_fixed_size_sample"](spark, SF_SMALL), "simple")


LAZY = ["q3_merchant_performance", "q8_customer_lifetime_value", "q11_top_merchants", "p10_rename_columns", "j5_lookup", "w1_rank"]


@pytest.mark.parametrize("key", LAZY)
def test_no_job_runs_while_a_frame_is_built(spark, ledger, key):
    queries()[key](spark, SF_SMALL)  # the ledger is written
    spark.sparkContext.setJobGroup(f"building-{key}", key)
    queries()[key](spark, SF_SMALL)
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup(f"building-{key}")) == []


def test_global_windows_only_above_the_daily_aggregate(spark):
    # The single-partition exchange for the unpartitioned window must come
    # after (above) the aggregate that reduces transactions to days.
    text = plan_text(queries()["q7_rolling_metrics"](spark, SF_SMALL), "simple")
    lines = text.splitlines()
    single = [i for i, line in enumerate(lines) if "SinglePartition" in line]
    final_agg = [i for i, line in enumerate(lines) if "HashAggregate" in line and "partial_" not in line]
    assert single and final_agg
    # In the tree text, a parent is printed above its children.
    assert max(single) < min(final_agg)


def test_partial_aggregation_before_the_merchant_join(spark):
    text = plan_text(queries()["q5_risk_indicators"](spark, SF_SMALL), "simple")
    assert "partial_count" in text


@pytest.mark.parametrize("key", ["q6_cohort_analysis", "q13_cohort_retention_12m", "q14_cohort_matrix", "k5_month3_retention_by_segment", "w2_lag_partitioned"])
def test_cohorts_count_bits_and_spell_out_no_month(spark, key):
    text = plan_text(queries()[key](spark, SF_SMALL), "simple")
    assert "partial_bit_or" in text and "Generate" not in text and "collect_set" not in text
    assert not re.search(r"hashpartitioning\([^)]*activity_month", text)


def test_month_filter_prunes_partitions(spark, ledger, tmp_path):
    path = str(tmp_path / "by_month")
    files.write_partitioned_ledger(ledger.transactions, path)
    df = files.read_month(spark, path, "1998-06-01")
    text = plan_text(df)
    assert re.search(r"PartitionFilters: \[[^\]]*transaction_month", text)
    whole = ledger.transactions.where("trunc(transaction_date, 'MM') = date'1998-06-01'").count()
    assert df.count() == whole


def test_fact_rows_are_pre_aggregated_before_any_shuffle(spark):
    """Every path from the transactions scan meets a partial aggregate before
    its first exchange or join, in the queries that join the fact table to a
    dimension (the fact side is reduced per key before it moves)."""
    from ledgerlens.plans.inspect import operators_above

    # (q5/q12 first attach each transaction's flag on the unique transaction
    # key, then reduce per merchant before the merchant join.)
    keys = ["q6_cohort_analysis", "f11_spend_per_month", "k3_volume_share_by_segment",
            "a7_multi_key_group", "r6_currency_match", "j6_null_key"]
    for key in keys:
        chains = operators_above(plan_text(queries()[key](spark, SF_SMALL), "simple"), "transactions")
        assert chains, key
        for chain in chains:
            upto = []
            for op in chain:
                if "Join" in op or op.startswith("Exchange"):
                    break
                upto.append(op)
            assert any("Aggregate(" in op for op in upto), (key, chain[:6])


def test_bucketed_transaction_tables_join_without_shuffle(spark):
    """transactions, settlements and fraud flags share a bucketing on
    transaction_id: with broadcasts off (as for tables of cluster size) their
    join reads matching buckets, with no exchange on either side."""
    from ledgerlens.operators import latency, risk
    from ledgerlens.sources.ledger import ledger_for

    L = ledger_for(spark, SF_SMALL)
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                          "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k in old:
            spark.conf.set(k, "-1")
        for df in (latency.settlement_micros(L.settlements, L.transactions),
                   risk.merchant_flag_counts(L.transactions, L.fraud_flags)):
            text = plan_text(df, "simple")
            assert "SortMergeJoin" in text
            join_at = next(i for i, ln in enumerate(text.splitlines()) if "SortMergeJoin" in ln)
            below = text.splitlines()[join_at:]
            assert not any("Exchange hashpartitioning(transaction_id" in ln for ln in below), text
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
