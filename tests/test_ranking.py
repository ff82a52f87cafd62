"""Ranking in pieces against the plain window, and transaction ids of large orders."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlens.operators.ranking import deal, descending_magnitude, rank_by_splitters, rank_within_groups
from ledgerlens.sources import fixtures

from .conftest import SF_SMALL


def skewed(spark):
    # Group 'a' holds most rows (with duplicate values); NULL is a group too.
    rows = [(i, "a", i // 3) for i in range(1000)] + [(1000 + i, "b", i % 4) for i in range(10)]
    rows += [(2000 + i, None, i) for i in range(5)] + [(3000, "b", None), (3001, "a", -7), (3002, "a", -9), (3003, "c", 0)]
    return spark.createDataFrame(rows, "id long, g string, v long")


@pytest.mark.parametrize("per_doubling", [1, 8, 200])
def test_rank_in_pieces_equals_the_plain_window(spark, per_doubling):
    df = skewed(spark)
    order = F.col("v").desc_nulls_first()
    want = {r.id: r.r for r in df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(order))).collect()}
    got = rank_within_groups(df, ["g"], [order], "r", descending_magnitude(F.col("v"), per_doubling))
    assert got.columns == ["id", "g", "v", "r"]
    assert {r.id: r.r for r in got.collect()} == want


def test_row_number_in_pieces_is_a_consistent_numbering(spark):
    by_group = {}
    for r in rank_within_groups(skewed(spark), ["g"], [F.col("v").desc_nulls_first()], "rn", descending_magnitude(F.col("v")), kind="row_number").collect():
        by_group.setdefault(r.g, []).append((r.rn, r.v))
    for g, items in by_group.items():
        items.sort()
        assert [rn for rn, _ in items] == list(range(1, len(items) + 1)), g
        values = [v for _, v in items if v is not None]
        assert values == sorted(values, reverse=True), g


@pytest.mark.parametrize("splitters", [2, 40, 300])
def test_rank_by_splitters_equals_the_plain_window(spark, splitters):
    df = skewed(spark)
    order = F.col("v").desc_nulls_first()
    want = {r.id: r.r for r in df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(order))).collect()}
    got = rank_by_splitters(df, ["g"], "v", "r", splitters)
    assert got.columns == ["id", "g", "v", "r"]
    assert {r.id: r.r for r in got.collect()} == want


CONCENTRATED = {
    "one doubling": "CAST(1000000 + pmod(id * 7919, 900001) AS decimal(15,2))",
    "a third equal": "CAST(IF(id % 3 = 0, 1500000, 1000000 + pmod(id * 7919, 900001)) AS decimal(15,2))",
    "all equal": "CAST(5 AS decimal(15,2))",
}


@pytest.mark.parametrize("kind", CONCENTRATED)
def test_splitters_balance_concentrated_values(spark, kind):
    df = spark.range(40_000).selectExpr("id", "IF(id % 4 = 0, 'b', 'a') AS g", f"{CONCENTRATED[kind]} AS v")
    dealt = deal(df, ["g"], "v", 64).repartition(8, "g", "_piece", "_salt")
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 40_000 and max(sizes) < 2 * 40_000 / 8
    want = df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(F.col("v").desc_nulls_first())))
    assert rank_by_splitters(df, ["g"], "v", "r").exceptAll(want).isEmpty()


def test_every_line_is_a_transaction_with_an_id_of_its_own(spark, ledger):
    lines = fixtures.read_driver(spark, SF_SMALL, "lineitem")
    assert ledger.transactions.count() == lines.count() == ledger.transactions.select("transaction_id").distinct().count()
    early = ledger.transactions.join(ledger.accounts, "account_id").where("to_date(transaction_date) < opened_date")
    assert early.count() == 0


def test_ids_are_unique_for_orders_of_any_size(spark):
    one = fixtures.read_driver(spark, SF_SMALL, "lineitem").limit(1).collect()[0].asDict()
    rows = [one | {"l_orderkey": o, "l_linenumber": n} for o in (1, 2, 12, 121, 12_101) for n in [*range(150), 10_001, *([3] * 120)]]
    lines = spark.createDataFrame(rows, fixtures.read_driver(spark, SF_SMALL, "lineitem").schema)
    accounts = spark.createDataFrame([(2, "EUR", None)], "account_id long, currency string, opened_date date").withColumn("opened_date", F.lit("1996-01-01").cast("date"))
    orders = spark.createDataFrame([(o, 1) for o in (1, 2, 12, 121, 12_101)], "o_orderkey long, o_custkey long")
    ids = [r.transaction_id for r in fixtures.derive_transactions(lines, orders, accounts).select("transaction_id").collect()]
    assert len(ids) == len(set(ids)) == len(rows)


def test_a_changed_input_gives_a_new_ledger(spark, tmp_path):
    import shutil

    from ledgerlens.sources.ledger import ledger_for

    for t in fixtures.DRIVER_COLUMNS:
        shutil.copy(f"{SF_SMALL}/{t}.parquet", tmp_path / f"{t}.parquet")
    n = ledger_for(spark, str(tmp_path)).transactions.count()
    half = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").where("l_orderkey % 2 = 0")
    half.write.parquet(str(tmp_path / "half"))
    (tmp_path / "lineitem.parquet").unlink()
    (tmp_path / "half").rename(tmp_path / "lineitem.parquet")
    assert 0 < ledger_for(spark, str(tmp_path)).transactions.count() == half.count() < n


def test_unbucketed_fallback_gives_the_same_ledger(spark, ledger, tmp_path):
    from ledgerlens.sources.ledger import write_ledger

    # An invalid table name makes the catalog registration fail.
    L = write_ledger(spark, SF_SMALL, str(tmp_path / "ledger"), buckets=4, table_prefix="not a name")
    assert L.transactions.exceptAll(ledger.transactions).count() == 0
    assert L.settlements.count() == ledger.settlements.count()
