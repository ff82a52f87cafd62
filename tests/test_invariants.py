
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import integrity as I
from ledgerlens.plans.registry import queries
from ledgerlens.sources import schemas as S

from .conftest import SF_MID, SF_SMALL


def q(spark, key, sf=SF_SMALL):
    return queries()[key](spark, sf)


def test_monthly_totals_equal_overview(spark):
    kpi = q(spark, "q9_overview_kpis").first()
    monthly = q(spark, "q10_monthly_trends").agg(F.sum("transaction_volume"), F.sum("total_value")).first()
    assert monthly[0] == kpi.total_tx_count
    assert abs(monthly[1] - kpi.total_tx_volume) < 1e-3


def test_matrix_unpivoted_equals_retention(spark):
    q13 = {(r.cohort_month.strftime("%Y-%m"), r.months_active_offset): r.retention_rate
           for r in q(spark, "q13_cohort_retention_12m").collect()}
    cells = {}
    for r in q(spark, "q14_cohort_matrix").collect():
        for o in range(13):
            if r[str(o)] is not None:
                cells[(r.cohort_month, o)] = r[str(o)]
    assert cells == q13


def test_retention_percent_agrees_with_q6(spark):
    q6 = {(r.cohort_month, r.months_active_offset): (r.active_customers, r.cohort_size)
          for r in q(spark, "q6_cohort_analysis").collect() if r.months_active_offset <= 12}
    q13 = {(r.cohort_month, r.months_active_offset): r.retention_rate
           for r in q(spark, "q13_cohort_retention_12m").collect()}
    assert set(q6) == set(q13)
    for k, (a, n) in q6.items():
        assert abs(q13[k] - 100 * a / n) <= 0.005 + 1e-9
        assert a <= n


def test_category_totals_cover_non_transfers(spark, ledger):
    total = q(spark, "q12_fraud_rate_by_category").agg(F.sum("total_transactions")).first()[0]
    assert total == ledger.transactions.where(F.col("transaction_type") != "transfer").count()


def test_dashboard_top_merchants_are_the_head_of_q3(spark):
    q3 = [r.merchant_name for r in q(spark, "q3_merchant_performance").collect()]
    q11 = [r.merchant_name for r in q(spark, "q11_top_merchants").collect()]
    assert q11 == q3[: len(q11)]


def test_rolling_sum_at_least_daily_amount(spark):
    rows = q(spark, "q7_rolling_metrics").collect()
    assert all(r.rolling_sum_30d >= r.daily_amount for r in rows)


def test_cascade_delete_leaves_no_orphans(spark, ledger):
    left = I.cascade_delete(ledger.as_dict(), ledger.customers.where(~F.col("is_active")))
    audits = I.union_all([I.foreign_key_audit(left[c], left[p], c, cc, p, pc) for c, cc, p, pc, _ in S.FOREIGN_KEYS])
    assert all(r.violations == 0 for r in audits.collect())
    assert left["customers"].count() == ledger.customers.where(F.col("is_active")).count()


def test_set_null_delete_keeps_every_transaction(spark, ledger):
    gone = ledger.merchants.limit(3)
    kept, tx = I.set_null_delete(ledger.merchants, ledger.transactions, gone)
    assert tx.count() == ledger.transactions.count()
    assert kept.count() == ledger.merchants.count() - 3
    ids = [r.merchant_id for r in gone.collect()]
    assert tx.where(F.col("merchant_id").isin(ids)).count() == 0


def _violations(df):
    return {r.rule: r.violations for r in df.collect()}


@pytest.mark.parametrize("sf, expected", [
    (SF_SMALL, {"i2": 1401, "i3": 138, "i5": 11, "r1": 2815, "r10": 27}),
    (SF_MID, {"i2": 14168, "i3": 1936, "i5": 122, "r1": 29157, "r10": 257}),
])
def test_audits_find_the_natural_violations(spark, sf, expected):
    got_i2 = _violations(q(spark, "i2_primary_key", sf))
    assert got_i2["primary_key:lineitem(l_orderkey,l_linenumber)"] == expected["i2"]
    assert all(v == 0 for k, v in got_i2.items() if "lineitem" not in k)
    assert _violations(q(spark, "i3_unique", sf))["unique:part(p_name)"] == expected["i3"]
    assert _violations(q(spark, "i5_range_check", sf))["range:customer.c_acctbal>=0"] == expected["i5"]
    assert _violations(q(spark, "r1_temporal_order", sf))["temporal:lineitem.l_shipdate>=orders.o_orderdate"] == expected["r1"]
    assert _violations(q(spark, "r10_account_coverage", sf))["coverage:orders->lineitem"] == expected["r10"]


def test_clean_ledger_passes_every_rule(spark):
    for key in ("i1_not_null", "i4_domain_check", "i7_length_check", "i8_numeric_fit",
                "r2_settlement_window", "r3_fee_band", "r4_settlement_balance", "r5_merchant_presence",
                "r6_currency_match", "r7_flag_timing"):
        assert all(v == 0 for k, v in _violations(q(spark, key)).items() if not k.startswith("dirty ")), key
    fk = _violations(q(spark, "i6_foreign_key"))
    assert all(v == 0 for k, v in fk.items() if "status=active" not in k)
    assert fk["foreign_key:transactions.account_id->accounts[status=active].account_id"] > 0


@pytest.mark.parametrize("key", ["i1_not_null", "i4_domain_check", "i7_length_check", "i8_numeric_fit",
                                 "r2_settlement_window", "r4_settlement_balance", "r5_merchant_presence", "r7_flag_timing"])
def test_every_rule_meets_violations_and_clean_rows_on_the_dirty_copies(spark, key):
    from ledgerlens.sources import schemas as S

    dirty = {r.rule: r for r in q(spark, key).collect() if r.rule.startswith("dirty ")}
    assert dirty
    for rule, r in dirty.items():
        if r.checked_rows > 30:  # the smallest tables have too few rows for every rule's remainder
            assert r.violations < r.checked_rows, rule
            if not any(rule.endswith(f".{k}") for keys in S.PRIMARY_KEYS.values() for k in keys if rule.startswith("dirty not_null")) and not rule.endswith("is_resolved"):
                assert r.violations > 0, rule
    assert any(r.violations for r in dirty.values())


def test_fixed_size_sample_is_repeatable(spark):
    a = [r.transaction_id for r in q(spark, "r9_fixed_size_sample").collect()]
    b = [r.transaction_id for r in q(spark, "r9_fixed_size_sample").collect()]
    assert a == b and len(a) == len(set(a)) == 1000


def test_offending_rows_agree_with_the_counts(spark):
    from ledgerlens.sources.fixtures import read_driver

    li = read_driver(spark, SF_SMALL, "lineitem", ["l_orderkey", "l_linenumber"])
    rows = I.duplicate_key_rows(li, ["l_orderkey", "l_linenumber"])
    distinct_keys = rows.select("l_orderkey", "l_linenumber").distinct().count()
    assert rows.count() - distinct_keys == 1401  # rows beyond the first per key
    cust = read_driver(spark, SF_SMALL, "customer", ["c_custkey", "c_acctbal"])
    assert I.range_rows(cust, "c_acctbal", ">=", 0).count() == 11
    assert I.null_rows(cust, ["c_custkey"]).count() == 0


def test_orphan_rows_against_active_accounts(spark, ledger):
    active = ledger.accounts.where(F.col("status") == "active")
    orphans = I.orphan_rows(ledger.transactions, active, "account_id", "account_id")
    got = {r.rule: r.violations for r in q(spark, "i6_foreign_key").collect()}
    assert orphans.count() == got["foreign_key:transactions.account_id->accounts[status=active].account_id"]


def test_ordered_load_rejects_orphans(spark, ledger, tmp_path):
    from ledgerlens.sources import files

    tables = ledger.as_dict()
    tables["accounts"] = tables["accounts"].where("account_id % 2 = 0")  # drop parents of some transactions
    paths = files.dump_csv(tables, str(tmp_path / "csv"))
    with pytest.raises(files.LoadAuditError):
        files.ordered_load(spark, paths, str(tmp_path / "parquet"))
    ok = files.ordered_load(spark, files.dump_csv(ledger.as_dict(), str(tmp_path / "csv2")), str(tmp_path / "pq2"))
    assert ok["transactions"].count() == ledger.transactions.count()


def test_a_refused_load_leaves_the_old_contents(spark, ledger, tmp_path):
    """One bad row of each kind, each alone, against a target that holds a good load."""
    from ledgerlens.sources import files

    good = files.dump_csv(ledger.as_dict(), str(tmp_path / "good"))
    target = str(tmp_path / "target")
    files.ordered_load(spark, good, target)
    before = {t: df.count() for t, df in ledger.as_dict().items()}
    first = lambda t: F.col(files.SCHEMAS[t].fieldNames()[0]) == ledger.table(t).agg(F.min(files.SCHEMAS[t].fieldNames()[0])).first()[0]
    bad = {
        "null": ("customers", "email", F.lit(None).cast("string")),
        "length": ("customers", "full_name", F.lit("x" * 150)),
        "domain": ("customers", "segment", F.lit("bogus")),
        "range": ("transactions", "amount", F.lit(-1).cast("decimal(15,2)")),
        "key": ("merchants", "merchant_id", F.lit(ledger.merchants.agg(F.max("merchant_id")).first()[0])),
        "orphan": ("accounts", "customer_id", F.lit(-5).cast("long")),
    }
    for kind, (t, c, value) in bad.items():
        paths = dict(good)
        paths[t] = str(tmp_path / kind)
        files.write_csv(ledger.table(t).withColumn(c, F.when(first(t), value).otherwise(F.col(c))), paths[t])
        with pytest.raises(files.LoadAuditError):
            files.ordered_load(spark, paths, target)
    assert {t: spark.read.parquet(f"{target}/{t}").count() for t in before} == before
    assert sorted(p.name for p in tmp_path.iterdir() if "staged" in p.name or "old" in p.name) == []


def test_csv_round_trip_of_awkward_text(spark, tmp_path):
    import csv
    import datetime as dt

    from ledgerlens.sources import files

    names = ["  padded ", 'He said "hi", ok', "two\nlines", "a,b;c", "back\\slash", "é漢", "'single'", '"']
    rows = [(i, n, f"{i}@x", "c", dt.date(2000, 1, 1), "retail", True) for i, n in enumerate(names)]
    df = spark.createDataFrame(rows, files.SCHEMAS["customers"])
    files.write_csv(df, str(tmp_path / "out"))
    assert {r.customer_id: r.full_name for r in files.read_csv(spark, str(tmp_path / "out"), "customers").collect()} == dict(enumerate(names))
    header = files.SCHEMAS["customers"].fieldNames()
    with open(tmp_path / "python.csv", "w", newline="") as f:
        csv.writer(f).writerows([header, *[(*r[:4], "2000-01-01", r[5], "true") for r in rows]])
    assert {r.customer_id: r.full_name for r in files.read_csv(spark, str(tmp_path / "python.csv"), "customers").collect()} == dict(enumerate(names))
    with open(tmp_path / "swapped.csv", "w", newline="") as f:
        csv.writer(f).writerows([["customer_id", "email", "full_name", *header[3:]], *[(*r[:4], "2000-01-01", r[5], "true") for r in rows]])
    with pytest.raises(Exception, match="header|schema|MALFORMED"):
        files.read_csv(spark, str(tmp_path / "swapped.csv"), "customers").collect()


def test_numeric_rows_that_do_not_fit(spark):
    df = spark.createDataFrame([(1, 1e13), (2, 9999999999999.99), (3, None), (4, -1e14)], "id long, v double")
    assert sorted(r.id for r in I.numeric_fit_rows(df, "v").collect()) == [1, 4]
