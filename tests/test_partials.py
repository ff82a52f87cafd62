"""Partials per month: merged results, what a refresh reads, late rows, stopped and disturbed refreshes."""

import re

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import rolling, trends
from ledgerlens.plans.inspect import plan_text
from ledgerlens.sources import files
from ledgerlens.sources.partials import NO_MONTH, PARTIAL, DailyPartials, LedgerChanging

MONTH = "1998-06-01"


@pytest.fixture
def rows(ledger):
    undated = ledger.transactions.limit(40).withColumns({"transaction_date": F.lit(None).cast("timestamp_ntz"), "transaction_id": -F.col("transaction_id")})
    return ledger.transactions.unionByName(undated)


@pytest.fixture
def kept(spark, rows, tmp_path):
    files.write_partitioned_ledger(rows, str(tmp_path / "ledger"))
    return DailyPartials(spark, str(tmp_path / "ledger"), str(tmp_path / "partials"))


def same(a, b):
    assert a.collect() == b.collect()


def test_results_equal_the_full_scan(kept, rows):
    partials = kept.refresh()
    same(trends.monthly_trends_from_partials(partials), trends.monthly_trends(rows))
    same(trends.overview_kpis_from_partials(partials), trends.overview_kpis(rows))
    same(rolling.rolling_from_daily(rolling.daily_totals_from_partials(partials)), rolling.rolling_metrics(rows))
    assert NO_MONTH in kept.stamps() and not kept.changed(kept.stamps(), kept.kept())


def test_late_rows_of_an_old_month_read_that_month_alone(spark, kept, rows):
    kept.refresh()
    before = kept.kept()
    late = rows.where(F.trunc("transaction_date", "MM") == F.lit(MONTH).cast("date")).withColumn("transaction_id", F.col("transaction_id") + 10**9)
    files.write_partitioned_ledger(late, kept.ledger, mode="append")
    stamps = kept.stamps()
    assert kept.changed(stamps, before) == [MONTH]
    text = plan_text(kept.partials_of(stamps, [MONTH]))
    assert re.search(r"PartitionFilters: \[[^\]]*transaction_month", text)
    assert kept.rows_of([MONTH]).select(F.trunc("transaction_date", "MM").cast("string")).distinct().collect() == [(MONTH,)]
    partials = kept.refresh()
    assert {k for k in kept.kept() if k not in before} == {(MONTH, stamps[MONTH])}
    same(trends.monthly_trends_from_partials(partials), trends.monthly_trends(rows.unionByName(late)))


def test_a_stopped_refresh_is_not_taken(kept, rows, tmp_path):
    stamps = kept.stamps()
    kept.partials_of(stamps, [MONTH]).withColumn("transaction_count", F.lit(7)).write.partitionBy("month", "stamp").parquet(f"{kept.folder}/run-stopped")
    (tmp_path / "partials/run-stopped/_SUCCESS").unlink()
    assert kept.kept() == {}
    same(trends.monthly_trends_from_partials(kept.refresh()), trends.monthly_trends(rows))


def test_files_that_change_under_a_refresh(kept, rows, monkeypatch):
    true, calls = kept.stamps, []

    def disturbed():
        calls.append(1)
        return {m: f"{s}-{len(calls)}" if len(calls) < 3 else s for m, s in true().items()}

    monkeypatch.setattr(kept, "stamps", disturbed)
    partials = kept.refresh()  # the first attempt sees two states
    assert len(calls) == 4 and {s for _, s in kept.kept()} == set(true().values())
    same(trends.overview_kpis_from_partials(partials), trends.overview_kpis(rows))
    monkeypatch.setattr(kept, "stamps", lambda: calls.append(1) or {m: f"{s}-{len(calls)}" for m, s in true().items()})
    with pytest.raises(LedgerChanging):
        kept.refresh()


def test_empty_ledger(spark, ledger, tmp_path):
    files.write_partitioned_ledger(ledger.transactions.limit(0), str(tmp_path / "ledger"))
    partials = DailyPartials(spark, str(tmp_path / "ledger"), str(tmp_path / "partials")).refresh()
    assert partials.schema == spark.createDataFrame([], PARTIAL).schema and partials.count() == 0
    same(trends.overview_kpis_from_partials(partials), trends.overview_kpis(ledger.transactions.limit(0)))
