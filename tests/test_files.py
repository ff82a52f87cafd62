"""CSV in many tasks, rejected rows, contents compared, one scan a fact (s1, s4, r11, f14)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import risk, rules
from ledgerlens.plans.inspect import plan_text
from ledgerlens.plans.registry import queries
from ledgerlens.sources import files

from .conftest import SF_SMALL


def customers(spark, names):
    rows = [(i, n, f"{i}@x", "c", dt.date(2000, 1, 1), "retail", True) for i, n in enumerate(names)]
    return spark.createDataFrame(rows, files.SCHEMAS["customers"])


def test_only_files_with_line_breaks_in_fields_are_read_whole(spark, tmp_path):
    plain = customers(spark, [f'name "{i}", x' for i in range(3000)])
    broken = customers(spark, [f"two\nlines {i}" for i in range(50)]).withColumn("customer_id", F.col("customer_id") + 10_000)
    files.write_csv(plain.coalesce(1), str(tmp_path / "a"))
    files.write_csv(broken.coalesce(1), str(tmp_path / "b"))
    both = str(tmp_path / "*" / "*.csv")
    found = files.files_by_line_breaks(spark, both)
    assert len(found[True]) == 1 and "/b/" in found[True][0] and len(found[False]) == 1
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert files.read_csv(spark, str(tmp_path / "a"), "customers").rdd.getNumPartitions() > 4
        got = files.read_csv(spark, both, "customers").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(map(tuple, got)) == sorted(map(tuple, plain.unionByName(broken).collect()))


@pytest.mark.parametrize("multi", [False, True])
def test_malformed_rows_fail_or_are_rejected_with_their_file(spark, tmp_path, multi):
    header = ",".join(files.SCHEMAS["customers"].fieldNames())
    name = '"two\nlines"' if multi else "plain"
    (tmp_path / "in.csv").write_text(f"{header}\n1,{name},a@x,c,2000-01-01,retail,true\nnot a number,n,b@x,c,2000-01-01,retail,true\n3,n,c@x,c,2000-13-41,retail,true\n4,n,d@x,c,2000-01-02,retail,false\n")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        files.read_csv(spark, str(tmp_path / "in.csv"), "customers").collect()
    good = files.read_csv(spark, str(tmp_path / "in.csv"), "customers", rejected=str(tmp_path / "bad"))
    assert sorted(r.customer_id for r in good.collect()) == [1, 4] and good.count() == 2
    bad = spark.read.parquet(str(tmp_path / "bad")).collect()
    assert sorted(r.row[:3] for r in bad) == ["3,n", "not"] and all(r.file.endswith("/in.csv") and r.table == "customers" for r in bad)


def test_contents_tell_swapped_lost_and_repeated_rows(spark, ledger):
    tx = ledger.transactions
    a, b = tx.orderBy("transaction_id").limit(2).collect()
    swapped = tx.withColumn("amount", F.when(F.col("transaction_id") == a.transaction_id, F.lit(b.amount)).when(F.col("transaction_id") == b.transaction_id, F.lit(a.amount)).otherwise(F.col("amount")))
    found = files.differing_rows(tx, swapped, "transactions")
    assert sorted((r.side, r.copies, r.transaction_id) for r in found.collect()) == sorted((s, 1, k.transaction_id) for s in ("source", "loaded") for k in (a, b))
    assert files.differing_buckets(tx, swapped, "transactions").count() <= 2
    doubled = tx.where(F.col("transaction_id") != a.transaction_id).unionByName(tx.where(F.col("transaction_id") == b.transaction_id))
    assert doubled.count() == tx.count()
    assert sorted((r.side, r.transaction_id) for r in files.differing_rows(tx, doubled, "transactions").collect()) == sorted([("source", a.transaction_id), ("loaded", b.transaction_id)])
    assert files.differing_rows(tx, tx.repartition(7), "transactions").isEmpty()


def test_rows_meet_the_differing_buckets_where_they_are(spark, ledger):
    """no row is moved to be told whether its bucket differs; rows move once, where it does."""
    tx = ledger.transactions
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables of any size
    try:
        text = plan_text(files.differing_rows(tx, tx.where("transaction_id % 103 <> 5"), "transactions"), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    semi = [line for line in text.splitlines() if "LeftSemi" in line]
    assert len(semi) == 2 and all("BroadcastHashJoin" in line for line in semi)
    exchanges = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert sum("amount" in line for line in exchanges) == 1 and all("amount" in line or "_bucket" in line for line in exchanges)


def test_a_dump_that_is_loaded_goes_table_by_table(spark, tmp_path, monkeypatch):
    """the CSV copy of a table isn't kept beside its parts, and the comparison is as before."""
    left = []
    real = files.ordered_load

    def load(spark, paths, target, *, audit=True, on_step=lambda step: None):
        def step(name):
            on_step(name)
            left.append((name, sorted(t for t in paths if list((tmp_path / "csv" / t).glob("*.csv")))))
        return real(spark, paths, target, audit=audit, on_step=step)

    monkeypatch.setattr(files, "ordered_load", load)
    monkeypatch.setattr(files, "fresh_dir", lambda spark, label: f"file://{tmp_path}")
    rows = {r.table_name: (r.only_source, r.only_loaded) for r in queries()["s4_content_reconcile"](spark, SF_SMALL).collect()}
    for i, t in enumerate(files.LOAD_ORDER):
        assert left[i] == (f"staged {t}", sorted(files.LOAD_ORDER[i + 1:]))
        assert rows[t] == (0, 0)
    assert rows["spoilt transactions"][0] > 0 < rows["spoilt transactions"][1]


def test_null_and_value_are_told_apart(spark):
    schema = files.SCHEMAS["fraud_flags"]
    when = dt.datetime(2000, 1, 1)
    row = lambda resolved: spark.createDataFrame([(1, 2, when, "r", True, resolved)], schema)
    assert files.differing_rows(row(None), row(when), "fraud_flags").count() == 2
    assert files.differing_rows(row(None), row(None), "fraud_flags").count() == 0
    none = spark.createDataFrame([], schema)
    assert [(r.side, r.copies) for r in files.differing_rows(row(None), none, "fraud_flags").collect()] == [("source", 1)]


def test_share_profile_has_no_lone_window(spark, ledger):
    text = plan_text(rules.share_profile(ledger.transactions, "status", "x"), "simple")
    assert "Window" not in text


def test_labels_read_each_fact_once_and_shuffle_none_before_the_merchant(spark, ledger):
    queries()["f14_number_labels"](spark, SF_SMALL)
    text = plan_text(risk.merchant_activity(ledger.transactions, ledger.fraud_flags, ledger.settlements), "simple")
    assert text.count("FileScan") == 3
    assert text.count("Exchange hashpartitioning(merchant_id") == 1 == text.count("Exchange hashpartitioning")
