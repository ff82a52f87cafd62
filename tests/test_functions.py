"""Hand-made edge cases (FIXTURES.md section 5) for the column helpers."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerlens.functions.numeric import mean_money, ratio_units, round_ratio
from ledgerlens.functions.temporal import age_months
from ledgerlens.functions.text import money_label, percent_label, thousands


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_age_months_matches_whole_month_rule(spark):
    cases = [
        ("2024-02-29 00:00", "2024-01-31 00:00", 0),
        ("2024-02-15 08:00", "2024-01-15 10:00", 0),
        ("2024-03-01 08:00", "2024-01-31 10:00", 1),
        ("2024-03-30 00:00", "2024-01-31 00:00", 1),
        ("2024-05-31 10:00", "2024-01-31 10:00", 4),
        ("2024-01-31 10:00", "2024-05-31 10:00", -4),
        ("2024-01-31 10:00", "2024-01-31 10:00", 0),
    ]
    df = spark.createDataFrame([(ts(e), ts(s), want) for e, s, want in cases], "e timestamp_ntz, s timestamp_ntz, want int")
    got = df.select(age_months("e", "s").alias("m"), "want").collect()
    assert [r.m for r in got] == [r.want for r in got]


def test_age_months_on_dates(spark):
    df = spark.createDataFrame([(dt.date(2024, 4, 1), dt.date(2023, 11, 1))], "a date, b date")
    assert df.select(age_months("a", "b")).first()[0] == 5


def test_mean_without_double_rounding(spark):
    # 10,000 x 0.01 and 10,001 x 0.00: the mean is 0.0049997..., so 0.00.
    df = spark.range(20001).select(F.when(F.col("id") < 10000, F.lit(Decimal("0.01"))).otherwise(F.lit(Decimal("0.00")))
                                   .cast("decimal(15,2)").alias("x"))
    got = df.agg(mean_money(F.sum("x"), F.count("x")).alias("m")).first().m
    assert got == 0.0


def test_half_away_from_zero(spark):
    df = spark.createDataFrame([(5, 2), (-5, 2), (1, 8), (3, 8)], "n long, d long")
    got = [r.u for r in df.select(ratio_units("n", "d", 0).alias("u")).collect()]
    assert got == [3, -3, 0, 0]
    got2 = [r.u for r in df.select(ratio_units("n", "d", 2).alias("u")).collect()]
    assert got2 == [250, -250, 13, 38]  # 0.125 -> 0.13, 0.375 -> 0.38


def test_round_ratio_four_digits(spark):
    df = spark.createDataFrame([(2, 3), (1, 7)], "n long, d long")
    assert [r.x for r in df.select(round_ratio("n", "d", 4).alias("x")).collect()] == [0.6667, 0.1429]


def test_labels(spark):
    df = spark.createDataFrame([(1234567, 123450, 1230), (12, 5, None)], "n long, c long, p long")
    rows = df.select(thousands("n").alias("a"), money_label("c").alias("b"), percent_label("p").alias("c")).collect()
    assert tuple(rows[0]) == ("1,234,567", "€1,234.50", "12.30%")
    assert tuple(rows[1]) == ("12", "€0.05", "-")


def test_partitioning_settings_follow_the_input_size():
    from ledgerlens.session import settings_for_input

    small = settings_for_input(10 * 1024 * 1024, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"
    big = settings_for_input(100 * 1024**4, 4000)
    assert big["spark.sql.shuffle.partitions"] == str(100 * 1024 * 8)  # one per 128 MB, no cap
    mid = settings_for_input(64 * 1024**3, 8)  # 64 GiB -> one per 128 MB
    assert mid["spark.sql.shuffle.partitions"] == "512"
    assert mid["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "512"




def test_sizes_and_files_of_folders_and_single_files(spark, tmp_path):
    from ledgerlens.session import path_bytes, path_files
    from ledgerlens.sources.ledger import bucket_count

    folder = tmp_path / "lineitem.parquet"
    folder.mkdir()
    (folder / "part-0").write_bytes(b"x" * 3000)
    with open(folder / "part-1", "wb") as f:
        f.truncate(9 * 512 * 1024 * 1024)  # sparse
    assert path_bytes(spark, str(folder)) == 3000 + 9 * 512 * 1024 * 1024
    assert bucket_count(spark, str(tmp_path)) == 10
    assert path_bytes(spark, str(folder / "part-0")) == 3000 and path_bytes(spark, str(tmp_path / "none")) == 0
    assert [x[1] for x in path_files(spark, str(folder))] == [3000, 9 * 512 * 1024 * 1024]


def test_a_bucket_of_the_written_ledger_is_of_one_size(spark, tmp_path):
    """F2-F4, F7, F9, F11: a bucket is sorted or counted by one task, so the input's size is no matter to it."""
    from ledgerlens.sources.ledger import LEDGER_BUCKET_BYTES, bucket_count

    for size in (1 << 30, 6 << 30):
        with open(tmp_path / "lineitem.parquet", "wb") as f:
            f.truncate(size)  # sparse
        assert size / bucket_count(spark, str(tmp_path), LEDGER_BUCKET_BYTES) <= 16 << 20
