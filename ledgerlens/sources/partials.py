"""Daily sums and counts kept beside a ledger laid out by month (q2, q7, q9, q10).

A dashboard asks for the same aggregates again and again, while only the newest months, and
now and then an old one that gets late rows, change.  :class:`DailyPartials` keeps, for every
month folder of the ledger, the count and the exact sum per (day, status), under a *stamp* of
the month's files (names, sizes, times).  A query merges the partials of the present stamps;
only months whose stamp has none are read from the ledger.

* Stamps are aggregated in Spark from a listing of the files (their contents are not read);
  one row a month comes to the driver.
* A refresh writes all its months into one new folder and uses it only with Spark's mark of
  a finished job, so a refresh that is stopped leaves nothing that a reader takes.
* If files change while a refresh reads them, its folder is dropped and it starts anew.
* Nothing is changed in place: an older state of the ledger finds its partials again.
* Rows without a date lie in a folder of their own, and so have their partials.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.temporal import day_of
from ledgerlens.session import file_system
from ledgerlens.sources.files import month_column
from ledgerlens.sources.schemas import SCHEMAS

PARTIAL = "transaction_date date, status string, transaction_count long, daily_amount decimal(38,2)"
MONTH = month_column("transaction_date")
#: The folder name that Spark gives rows whose partition column is null.
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"
ATTEMPTS = 5


class LedgerChanging(RuntimeError):
    """The ledger's files changed under every attempt to read them."""


class DailyPartials:
    def __init__(self, spark: SparkSession, ledger: str, folder: str):
        self.spark, self.ledger, self.folder = spark, ledger.rstrip("/"), folder.rstrip("/")

    def stamps(self) -> dict[str, str]:
        """Month -> stamp of its files in the ledger as it is now."""
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(self.ledger)
        month = F.regexp_extract("path", rf"/{MONTH}=([^/]+)/", 1).alias("month")
        file = F.xxhash64("path", "length", "modificationTime")
        found = files.groupBy(month).agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes"), F.bit_xor(file).alias("all"))
        return {r.month: f"{r.n}-{r.bytes}-{r['all'] & (2**64 - 1):016x}" for r in found.collect()}  # one row a month

    def kept(self) -> dict[tuple[str, str], str]:
        """(month, stamp) -> folder, of finished refreshes."""
        fs, root = file_system(self.spark, self.folder)
        folders = {}
        for run in fs.listStatus(root) if fs.exists(root) else []:
            if not fs.exists(file_system(self.spark, f"{run.getPath()}/_SUCCESS")[1]):
                continue
            for month in fs.listStatus(run.getPath()):
                if month.isDirectory():
                    for stamp in fs.listStatus(month.getPath()):
                        at = stamp.getPath()
                        folders[month.getPath().getName().split("=", 1)[1], at.getName().split("=", 1)[1]] = at.toString()
        return folders

    def rows_of(self, months: list[str]) -> DataFrame:
        """The ledger's rows of some months (directory pruning)."""
        schema = T.StructType([*SCHEMAS["transactions"].fields, T.StructField(MONTH, T.DateType())])
        dated = [F.lit(m).cast("date") for m in months if m != NO_MONTH]
        chosen = F.col(MONTH).isin(*dated) if dated else F.lit(False)
        return self.spark.read.schema(schema).parquet(self.ledger).where(chosen | F.col(MONTH).isNull() if NO_MONTH in months else chosen)

    def changed(self, stamps: dict[str, str], kept: dict[tuple[str, str], str]) -> list[str]:
        return sorted(m for m, s in stamps.items() if (m, s) not in kept)

    def partials_of(self, stamps: dict[str, str], months: list[str]) -> DataFrame:
        """Partials of some months, with their month and stamp."""
        month = F.coalesce(F.date_format(MONTH, "yyyy-MM-dd"), F.lit(NO_MONTH)).alias("month")
        per_day = self.rows_of(months).groupBy(month, day_of("transaction_date").alias("transaction_date"), "status").agg(
            F.count("transaction_id").alias("transaction_count"), F.sum("amount").cast("decimal(38,2)").alias("daily_amount"))
        stamp: Column = F.element_at(F.create_map(*[F.lit(x) for m in months for x in (m, stamps[m])]), F.col("month"))
        return per_day.withColumn("stamp", stamp)

    def refresh(self) -> DataFrame:
        """Partials of all months (schema ``PARTIAL``); months that have changed are read from the ledger."""
        for _ in range(ATTEMPTS):
            stamps, kept = self.stamps(), self.kept()
            months = self.changed(stamps, kept)
            if not months:
                break
            run = f"{self.folder}/run-{uuid.uuid4().hex[:12]}"
            self.partials_of(stamps, months).repartition("month").write.partitionBy("month", "stamp").parquet(run)
            after = self.stamps()
            if any(after.get(m) != stamps[m] for m in months):
                fs, at = file_system(self.spark, run)
                fs.delete(at, True)  # read from files that were changing
                continue
            kept = self.kept()
            break
        else:
            raise LedgerChanging(f"{self.ledger} changed during {ATTEMPTS} attempts")
        folders = [kept[m, s] for m, s in sorted(stamps.items()) if (m, s) in kept]
        return self.spark.read.schema(PARTIAL).parquet(*folders) if folders else self.spark.createDataFrame([], PARTIAL)
