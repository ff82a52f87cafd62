"""CSV and Parquet in and out of the ledger (s1-s5, s8, s9).

* CSV is the common dialect: a header row, UTF-8, fields quoted with ``"`` and
  quotes doubled, line breaks allowed inside quotes, spaces kept, an empty field is
  NULL, timestamps as ``yyyy-MM-dd HH:mm:ss``.  Reads always use the fixed schema
  (never inference), check the header's names, and fail fast on a malformed row.
* Loads write new parts, audit them as written and then commit all tables together
  (:mod:`ledgerlens.sources.generations`), so a rerun ends in the same state and a load
  that is refused or stopped leaves the old contents.
* The date-partitioned ledger replaces the reference's date indexes: a month
  filter prunes whole directories before any file is opened.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyspark.sql.types as T
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.temporal import month_start
from ledgerlens.session import checkpoint_root, file_system
from ledgerlens.sources.generations import Store
from ledgerlens.sources.schemas import LOAD_ORDER, PRIMARY_KEYS, SCHEMAS

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


# One dialect for both directions.
CSV_DIALECT = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "timestampNTZFormat": TIMESTAMP_FORMAT,
    "dateFormat": DATE_FORMAT,
}


def write_csv(df: DataFrame, path: str) -> None:
    """s5: CSV with a header; NULL as an empty field."""
    df.write.mode("overwrite").options(**CSV_DIALECT, emptyValue="").csv(path)


def files_by_line_breaks(spark: SparkSession, path: str) -> dict[bool, list[str]]:
    """The CSV files below ``path``, by whether a field holds a line break: a line has an odd number of quotes.

    A first pass over the lines, in as many tasks as the bytes ask for; one row a file comes back."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    odd = F.pmod(F.length("value") - F.length(F.translate("value", '"', "")), F.lit(2)) == 1
    out: dict[bool, list[str]] = {False: [], True: []}
    for r in lines.groupBy("file").agg(F.bool_or(odd).alias("odd")).collect():
        out[r.odd].append(r.file)
    return out


def read_csv(spark: SparkSession, path: str, table: str, *, rejected: str | None = None) -> DataFrame:
    """s1: typed CSV scan with the table's fixed schema.

    A file without line breaks inside fields is split over tasks; only files that have some
    are read by one task each.  A malformed row fails the scan or, with ``rejected``, goes to
    that folder as Parquet (table, file, row) and the others are read."""
    found = files_by_line_breaks(spark, path)
    whole, broken = found[False] if found[True] else [path], found[True]
    options = dict(CSV_DIALECT, enforceSchema=False)
    schema = SCHEMAS[table]
    if rejected is None:
        options["mode"] = "FAILFAST"
    else:
        options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_row", "columnPruning": False}  # every field is parsed, whatever is read
        schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in schema.fields], T.StructField("_row", T.StringType())])
    reader = spark.read.schema(schema).options(**options)
    frames = ([reader.csv(whole)] if whole else []) + ([reader.option("multiLine", True).csv(broken)] if broken else [])
    if rejected is None:
        rows = frames[0]
    else:
        frames = [df.withColumn("_file", F.col("_metadata.file_path")) for df in frames]
        rows = frames[0]
    for df in frames[1:]:
        rows = rows.unionByName(df)
    if rejected is None:
        return rows
    parsed = F.hash(*SCHEMAS[table].fieldNames()).between(-(2**31), 2**31 - 1)  # always; a scan of the rejected rows alone isn't allowed
    bad = rows.where(parsed & F.col("_row").isNotNull()).select(F.lit(table).alias("table"), F.col("_file").alias("file"), F.col("_row").alias("row"))
    bad.write.mode("append").parquet(rejected)
    return rows.where(parsed & F.col("_row").isNull()).select(SCHEMAS[table].fieldNames())


def reload(df: DataFrame, target: str, table: str) -> DataFrame:
    """s2: replace one table of the store ``target`` with ``df`` (idempotent; one commit)."""
    store = Store(df.sparkSession, target)
    return store.read(table, store.replace({table: df}))


def dump_csv(tables: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """Write each table as CSV into ``folder/<table>``."""
    paths = {}
    for name in LOAD_ORDER:
        paths[name] = f"{folder}/{name}"
        write_csv(tables[name], paths[name])
    return paths


class LoadAuditError(ValueError):
    """A ledger to be loaded broke a constraint."""


def ordered_load(spark: SparkSession, csv_paths: dict[str, str], target: str, *, audit: bool = True,
                 on_step: Callable[[str], None] = lambda step: None) -> dict[str, DataFrame]:
    """s3: write the six tables (CSV -> typed Parquet, parents before children) as new parts of the
    store ``target``, audit every declared constraint of them as written, and commit all six in one
    step.  A violation raises :class:`LoadAuditError`; the store stays as it was then, and when the
    load is stopped anywhere before its commit.  Returns the loaded tables."""

    from ledgerlens.operators.constraints import constraint_audits

    def check(staged: dict[str, DataFrame]) -> None:
        bad = [(r.rule, r.violations) for r in constraint_audits(staged).where(F.col("violations") > 0).collect()]
        if bad:
            raise LoadAuditError(f"constraints broken by the load, nothing published: {bad}")

    store = Store(spark, target)
    new = store.replace({name: read_csv(spark, csv_paths[name], name) for name in LOAD_ORDER}, check=check if audit else None, on_step=on_step)
    return store.tables(new)


def dropping_staged(spark: SparkSession, csv_paths: dict[str, str]) -> Callable[[str], None]:
    """An ``on_step`` of ``ordered_load`` for a CSV dump that nobody else reads: each table's files go once its parts are written."""

    def on_step(step: str) -> None:
        name = step.removeprefix("staged ")
        if name != step:
            fs, at = file_system(spark, csv_paths[name])
            fs.delete(at, True)

    return on_step


def row_counts(tables: dict[str, DataFrame], column: str) -> DataFrame:
    """(table_name, <column>) with one count job per table, unioned."""
    frames = [
        df.agg(F.count(F.lit(1)).alias(column)).select(F.lit(name).alias("table_name"), column)
        for name, df in tables.items()
    ]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def reconcile(source: dict[str, DataFrame], loaded: dict[str, DataFrame]) -> DataFrame:
    """s4: row counts of source and target side by side."""
    s = row_counts(source, "source_rows")
    t = row_counts(loaded, "loaded_rows")
    return s.join(t, "table_name", "full").select(
        "table_name", "source_rows", "loaded_rows",
        (F.coalesce(F.col("source_rows"), F.lit(-1)) == F.coalesce(F.col("loaded_rows"), F.lit(-2))).alias("matches"),
    )


#: Buckets of a content comparison; only rows of buckets that differ are compared.
CONTENT_BUCKETS = 4096


def _fingerprinted(df: DataFrame, table: str, buckets: int) -> DataFrame:
    """``df`` with _bucket (of its key) and _hash (of all columns, nulls told from values)."""
    columns = [c for f in SCHEMAS[table].fields for c in (F.col(f.name).isNull(), F.col(f.name))]
    key = [F.col(c) for c in PRIMARY_KEYS[table]]
    return df.withColumns({"_bucket": F.pmod(F.xxhash64(*key), F.lit(buckets)), "_hash": F.xxhash64(*columns)})


def bucket_fingerprints(df: DataFrame, table: str, buckets: int = CONTENT_BUCKETS) -> DataFrame:
    """Per bucket of keys: row count, and sum and exclusive-or of a hash of each row; the rows' order is no matter."""
    marked = _fingerprinted(df, table, buckets)
    return marked.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("_hash").cast("decimal(20,0)")).alias("total"), F.bit_xor("_hash").alias("mixed"))


def differing_buckets(source: DataFrame, loaded: DataFrame, table: str, buckets: int = CONTENT_BUCKETS) -> DataFrame:
    """The buckets whose fingerprints differ (or that one side lacks)."""
    a = bucket_fingerprints(source, table, buckets).select("_bucket", F.struct("n", "total", "mixed").alias("a"))
    b = bucket_fingerprints(loaded, table, buckets).select("_bucket", F.struct("n", "total", "mixed").alias("b"))
    return a.join(b, "_bucket", "full").where(~F.col("a").eqNullSafe(F.col("b"))).select("_bucket")


def differing_rows(source: DataFrame, loaded: DataFrame, table: str, buckets: int = CONTENT_BUCKETS) -> DataFrame:
    """Rows of one side only (side, copies, the table's columns): as many copies as one side has more than the other.

    Tables are compared bucket by bucket; rows are brought together only where buckets differ.  The
    differing buckets, at most ``buckets`` numbers, go to the rows: a row is moved once, to meet its like,
    and none where no bucket differs."""
    names = SCHEMAS[table].fieldNames()
    differ = F.broadcast(differing_buckets(source, loaded, table, buckets))

    def of(df: DataFrame, sign: int) -> DataFrame:
        return _fingerprinted(df.select(names), table, buckets).join(differ, "_bucket", "left_semi").select(*names, F.lit(sign).alias("_sign"))

    net = of(source, 1).unionByName(of(loaded, -1)).groupBy(*names).agg(F.sum("_sign").alias("_net")).where("_net <> 0")
    return net.select(F.when(F.col("_net") > 0, "source").otherwise("loaded").alias("side"), F.abs("_net").alias("copies"), *names)


def reconcile_contents(source: dict[str, DataFrame], loaded: dict[str, DataFrame]) -> DataFrame:
    """s4: rows that only the source or only the target holds, per table."""
    frames = []
    for t in source:
        rows = differing_rows(source[t], loaded[t], t)
        only = lambda side: F.coalesce(F.sum(F.when(F.col("side") == side, F.col("copies"))), F.lit(0)).alias(f"only_{side}")
        frames.append(rows.agg(only("source"), only("loaded")).select(F.lit(t).alias("table_name"), "only_source", "only_loaded"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def month_column(date_col: str) -> str:
    return date_col.removesuffix("_date") + "_month"


def write_partitioned_ledger(rows: DataFrame, path: str, date_col: str = "transaction_date", key: str = "transaction_id", mode: str = "overwrite") -> None:
    """s9: a table laid out by the month of ``date_col`` (``mode="append"`` adds rows to it).

    Rows are range-partitioned on (month, key) before the write: each task covers a
    slice of consecutive months, so it writes into few month directories, and a month
    holding a large share of the rows is split over several tasks."""
    month = month_column(date_col)
    rows.withColumn(month, month_start(date_col)).repartitionByRange(month, key).write.mode(mode).partitionBy(month).parquet(path)


def read_month(spark: SparkSession, path: str, month: str, table: str = "transactions", date_col: str = "transaction_date") -> DataFrame:
    """One month of a table laid out by month: the filter on the partition column
    becomes a ``PartitionFilters`` entry (directory pruning).  The schema is fixed."""
    column = month_column(date_col)
    schema = T.StructType([*SCHEMAS[table].fields, T.StructField(column, T.DateType())])
    return spark.read.schema(schema).parquet(path).where(F.col(column) == F.lit(month).cast("date"))
