"""The ledger: six DataFrames, derived lazily or read back from written tables.

``ledger_for(spark, sf_dir)`` derives the ledger from the driver tables once,
writes each table as Parquet under the shared checkpoint folder and returns
DataFrames that read those files.  Writing cuts the lineage (the per-order
window and the joins run once, not once per query) and survives executor
loss: a lost task re-reads files instead of recomputing the derivation.

The three tables keyed by transaction (transactions, settlements, fraud
flags) are written bucketed on ``transaction_id`` with the same bucket count
and sorted within buckets.  Joins among them - settled revenue, latency,
flag rates, several audits - then read matching buckets side by side: no
shuffle of either side and no sort.  Bucketed tables live in the session
catalog; a new session re-attaches the written files with ``CREATE TABLE ...
LOCATION``.
"""

from __future__ import annotations

import hashlib
import logging
import math
import threading
import uuid
from dataclasses import dataclass, fields

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ledgerlens.session import checkpoint_root, file_system, path_bytes, path_files
from ledgerlens.sources import fixtures
from ledgerlens.sources.schemas import LOAD_ORDER, SCHEMAS

log = logging.getLogger(__name__)

# Bump when a derivation rule changes, so stale written tables are not reused.
MAPPING_VERSION = "3"

# Tables written bucketed, and their bucket column.
BUCKETED = {"transactions": "transaction_id", "settlements": "transaction_id", "fraud_flags": "transaction_id"}
BUCKET_INPUT_BYTES = 512 * 1024 * 1024
# What a written ledger has: line items are about 12 bytes a row as Parquet, so a task
# that sorts or counts a whole bucket by transaction holds some 1.3 million rows.
LEDGER_BUCKET_BYTES = 16 * 1024 * 1024
MIN_BUCKETS = 8


@dataclass(frozen=True)
class Ledger:
    customers: DataFrame
    accounts: DataFrame
    merchants: DataFrame
    transactions: DataFrame
    settlements: DataFrame
    fraud_flags: DataFrame

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    def as_dict(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}

    def register_views(self, prefix: str | None = None) -> str:
        """Temp views named after the tables, for ``spark.sql`` (s6).

        The default prefix is unique to this ledger object, so ledgers of
        different inputs in one session never replace each other's views.
        Returns the prefix used."""
        prefix = f"ledger_{id(self):x}_" if prefix is None else prefix
        for name, df in self.as_dict().items():
            df.createOrReplaceTempView(prefix + name)
        return prefix


def derive_ledger(spark: SparkSession, sf_dir: str) -> Ledger:
    """Lazy ledger straight from the driver tables (no writes)."""
    nation = fixtures.read_driver(spark, sf_dir, "nation")
    customers = fixtures.derive_customers(fixtures.read_driver(spark, sf_dir, "customer"), nation)
    accounts = fixtures.derive_accounts(customers)
    merchants = fixtures.derive_merchants(fixtures.read_driver(spark, sf_dir, "supplier"), nation)
    transactions = fixtures.derive_transactions(
        fixtures.read_driver(spark, sf_dir, "lineitem"),
        fixtures.read_driver(spark, sf_dir, "orders"),
        accounts,
    )
    return Ledger(
        customers=customers,
        accounts=accounts,
        merchants=merchants,
        transactions=transactions,
        settlements=fixtures.derive_settlements(transactions, merchants),
        fraud_flags=fixtures.derive_fraud_flags(transactions),
    )


def read_ledger(spark: SparkSession, path: str) -> Ledger:
    """Read a written ledger with the fixed schemas (no inference)."""
    return Ledger(**{
        name: spark.read.schema(SCHEMAS[name]).parquet(f"{path}/{name}") for name in LOAD_ORDER
    })


def _done(spark: SparkSession, path: str) -> bool:
    """Whether a completed write (its ``_SUCCESS`` marker) exists at ``path``.

    Uses the Hadoop file system of the path, so it works for any shared store
    the checkpoint folder lives on."""
    fs, marker = file_system(spark, f"{path}/_SUCCESS")
    return bool(fs.exists(marker))


def bucket_count(spark: SparkSession, sf_dir: str, bucket_bytes: int = BUCKET_INPUT_BYTES) -> int:
    """Buckets for the transaction-keyed tables: one per ``bucket_bytes`` of line-item
    input, so a bucket has the same size whatever the input's."""
    return max(MIN_BUCKETS, math.ceil(path_bytes(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet") / bucket_bytes))


def _ddl(name: str) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in SCHEMAS[name].fields)


def write_ledger(spark: SparkSession, sf_dir: str, path: str, *, buckets: int | None = None,
                 table_prefix: str | None = None) -> Ledger:
    """Derive and write the ledger table by table; children are derived from
    their parents as written, so nothing upstream is computed twice.

    With ``buckets`` the transaction-keyed tables are written bucketed (see
    the module notes) and registered as ``<table_prefix>_<table>``.
    """

    def write(name: str, df: DataFrame) -> DataFrame:
        target = f"{path}/{name}"
        if buckets and name in BUCKETED:
            try:
                return write_bucketed(name, df, target)
            except AnalysisException as err:
                # Bucketing needs the session catalog.  Where it refuses the
                # table, the table is written plain: same rows, the joins just
                # shuffle.  Any other failure is the job's own and is raised.
                log.warning("bucketed write of %s failed (%s); writing it unbucketed", name, err)
                target = f"{target}-plain"
        if not _done(spark, target):
            df.write.mode("overwrite").parquet(target)
        return spark.read.schema(SCHEMAS[name]).parquet(target)

    def write_bucketed(name: str, df: DataFrame, target: str) -> DataFrame:
        col = BUCKETED[name]
        table = f"{table_prefix}_{name}"
        if not _done(spark, target):
            (
                df.repartition(buckets, col)  # one task per bucket: one file per bucket
                .write.mode("overwrite")
                .bucketBy(buckets, col)
                .sortBy(col)
                .option("path", target)
                .saveAsTable(table)
            )
        else:
            spark.sql(f"DROP TABLE IF EXISTS {table}")  # external: its files stay, an old location goes
            spark.sql(
                f"CREATE TABLE {table} ({_ddl(name)}) USING parquet "
                f"CLUSTERED BY ({col}) SORTED BY ({col}) INTO {buckets} BUCKETS LOCATION '{target}'"
            )
        return spark.table(table).select(*SCHEMAS[name].fieldNames())

    nation = fixtures.read_driver(spark, sf_dir, "nation")
    customers = write("customers", fixtures.derive_customers(fixtures.read_driver(spark, sf_dir, "customer"), nation))
    accounts = write("accounts", fixtures.derive_accounts(customers))
    merchants = write("merchants", fixtures.derive_merchants(fixtures.read_driver(spark, sf_dir, "supplier"), nation))
    transactions = write("transactions", fixtures.derive_transactions(
        fixtures.read_driver(spark, sf_dir, "lineitem"),
        fixtures.read_driver(spark, sf_dir, "orders"),
        accounts,
    ))
    settlements = write("settlements", fixtures.derive_settlements(transactions, merchants))
    fraud_flags = write("fraud_flags", fixtures.derive_fraud_flags(transactions))
    return Ledger(customers, accounts, merchants, transactions, settlements, fraud_flags)


def _source_key(spark: SparkSession, sf_dir: str) -> str:
    """A digest of the mapping and of every source file's path, length and time."""
    h = hashlib.sha1(f"{MAPPING_VERSION}:{sf_dir.rstrip('/')}".encode())
    for name in sorted(fixtures.DRIVER_COLUMNS):
        for f in path_files(spark, f"{sf_dir.rstrip('/')}/{name}.parquet"):
            h.update(repr((name, *f)).encode())
    return h.hexdigest()[:16]


_LOCK = threading.Lock()
_CACHE: dict[tuple[str, int, str], Ledger] = {}


def ledger_for(spark: SparkSession, sf_dir: str, *, fresh: bool = False) -> Ledger:
    """The written ledger for ``sf_dir`` (derived and written on first use).

    Written tables are reused within and across sessions as long as the source
    files are the same ones (the folder is keyed by them and the mapping version).  ``fresh=True`` derives and writes
    a new copy in its own folder (used to time the derivation)."""
    source = _source_key(spark, sf_dir)
    key = (spark.sparkContext.applicationId, id(spark), source)
    with _LOCK:
        if fresh or key not in _CACHE:
            buckets = bucket_count(spark, sf_dir, LEDGER_BUCKET_BYTES)
            if fresh:
                source = f"{source}_{uuid.uuid4().hex[:8]}"
            path = f"{checkpoint_root(spark)}/ledger-{source}-b{buckets}"
            _CACHE[key] = write_ledger(spark, sf_dir, path, buckets=buckets, table_prefix=f"ledgerlens_{source}")
        return _CACHE[key]
