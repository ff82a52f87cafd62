"""Constraints in few passes: bitmaps for keys, one scan for all rules (i1-i7)."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import constraints as C
from ledgerlens.operators import integrity as I
from ledgerlens.plans.dirty import dirty
from ledgerlens.plans.inspect import plan_text
from ledgerlens.sources import schemas as S


def rows(df):
    return sorted(map(tuple, df.select("rule", "checked_rows", "violations").collect()))


KEYS = {
    "dense": "id",
    "dense with copies": "id div 2",
    "a third equal": "IF(id % 3 = 0, 40000, id)",
    "nulls": "IF(id % 5 = 0, NULL, id)",
    "sparse": "id * 1000003",
    "sparse with copies": "(id div 3) * 1000003",
    "negative": "id - 500",
    "all null": "CAST(NULL AS BIGINT)",
}


@pytest.mark.parametrize("kind", KEYS)
def test_key_audits_equal_counts_per_key(spark, kind):
    df = spark.range(100_000).selectExpr(f"{KEYS[kind]} AS k", "id % 7 AS a", "concat('t', id % 9) AS b")
    want = rows(I.union_all([I.primary_key_audit(df, "t", ["k"]), I.unique_audit(df, "t", ["k"]), I.unique_audit(df, "t", ["b"]), I.primary_key_audit(df, "t", ["a", "b"])]))
    assert rows(C.key_audits(df, "t", [("primary_key", ["k"]), ("unique", ["k"]), ("unique", ["b"]), ("primary_key", ["a", "b"])])) == want


@pytest.mark.parametrize("orphans", ["k", "IF(k % 1000 = 7, k + 500000, k)", "IF(k % 3 = 0, 90001, k)", "IF(k % 4 = 0, NULL, k)", "-k"])
def test_foreign_keys_equal_counts_per_key(spark, orphans):
    child = spark.range(60_000).selectExpr("id % 50000 AS k").selectExpr("k", f"{orphans} AS l", f"({orphans}) * 1000003 AS m")
    parent = spark.range(50_000).selectExpr("id AS p", "id * 1000003 AS q")
    links = [("k", "d", parent, "p"), ("l", "d", parent, "p"), ("m", "s", parent, "q")]
    want = rows(I.union_all([I.foreign_key_audit(child, df, "c", c, n, p) for c, n, df, p in links]))
    assert rows(C.foreign_key_audits(child, "c", links)) == want


def test_empty_tables(spark):
    none = spark.createDataFrame([], "k long, b string")
    keys = [("primary_key", ["k"]), ("unique", ["b"])]
    assert rows(C.key_audits(none, "t", keys)) == [("primary_key:t(k)", 0, 0), ("unique:t(b)", 0, 0)]
    some = spark.range(10).toDF("k")
    assert rows(C.foreign_key_audits(some, "c", [("k", "p", none, "k")])) == [("foreign_key:c.k->p.k", 10, 10)]
    assert rows(C.foreign_key_audits(none, "c", [("k", "p", some, "k")])) == [("foreign_key:c.k->p.k", 0, 0)]


def _one_by_one(tables):
    out = []
    for t, df in tables.items():
        of = lambda m: {c: v for (n, c), v in m.items() if n == t}  # noqa: B023, E731
        out += [I.not_null_audit(df, t, S.required_columns(t)), I.primary_key_audit(df, t, S.PRIMARY_KEYS[t]), I.length_audit(df, t, of(S.LENGTHS))]
        out += [I.unique_audit(df, t, k) for k in S.UNIQUE_KEYS.get(t, [])]
        out += [I.domain_audit(df, t, of(S.DOMAINS))] if of(S.DOMAINS) else []
        checks = [(c, op, b) for n, c, op, b in S.RANGES if n == t]
        out += [I.range_audit(df, t, checks)] if checks else []
    out += [I.foreign_key_audit(tables[c], tables[p], c, cc, p, pc) for c, cc, p, pc, _ in S.FOREIGN_KEYS]
    return I.union_all(out)


def test_one_pass_equals_the_audits_one_by_one(spark, ledger):
    tables = {t: dirty(t, df).cache() for t, df in ledger.as_dict().items()}
    got = rows(C.constraint_audits(tables))
    assert got == rows(_one_by_one(tables))
    assert sum(v for *_, v in got) > 0


def test_one_scan_for_all_foreign_keys_of_a_child_and_no_key_in_the_exchange(spark, ledger):
    dense = {"accounts": {"account_id"}, "merchants": {"merchant_id"}}
    own = C.bitmaps(C._exploded(ledger.transactions, {"a": "account_id", "m": "merchant_id"}))
    text = plan_text(own, "simple")
    assert text.count("FileScan") == 1
    exchange = next(line for line in text.splitlines() if "Exchange" in line)
    assert "hashpartitioning(rule" in exchange and "key#" not in exchange and "account_id" not in exchange
    assert rows(C.foreign_key_audits(ledger.transactions, "transactions", [("account_id", "accounts", ledger.accounts, "account_id"), ("merchant_id", "merchants", ledger.merchants, "merchant_id")], dense))[0][2] == 0


def test_a_hot_key_is_one_bit(spark):
    df = spark.range(200_000).select(F.lit("r").alias("rule"), F.lit(7).cast("long").alias("key"))
    (row,) = C.bitmaps(df).select("n", F.bitmap_count("bits").alias("bits")).collect()
    assert tuple(row) == (200_000, 1)


def test_bitmaps_are_merged_in_hash_tables(spark, ledger):
    """a task neither sorts its rows for the bitmaps nor holds 4 KB a key that lies alone."""
    text = plan_text(C.bitmaps(C._exploded(ledger.transactions, {"a": "account_id", "m": "merchant_id"})), "simple")
    assert "HashAggregate" in text and "SortAggregate" not in text and "ObjectHashAggregate" not in text


def test_keys_at_the_ends_of_a_long(spark):
    child = spark.createDataFrame([(k,) for k in (-(2**63), -64, -1, 0, 63, 64, 2**63 - 1, None, 5, 5)], "k long")
    parent = spark.range(100).toDF("p")
    assert rows(C.foreign_key_audits(child, "c", [("k", "d", parent, "p")])) == rows(I.foreign_key_audit(child, parent, "c", "k", "d", "p"))
