"""Scans, sources and sinks (s1-s9).

Each key performs its writes into a fresh folder under the shared checkpoint
root when called, and returns a DataFrame reading what was written, so the
oracle can compare it with the table it came from.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import rolling, trends
from ledgerlens.operators.integrity import union_all
from ledgerlens.plans.catalog_core import SERIES, TRENDS
from ledgerlens.plans.registry import query
from ledgerlens.sources import files
from ledgerlens.sources.ledger import ledger_for
from ledgerlens.sources.partials import DailyPartials
from ledgerlens.sources.schemas import LOAD_ORDER, PRIMARY_KEYS, SCHEMAS, conform


@query("s1_csv_scan", """
SELECT transaction_id, account_id, merchant_id, CAST(amount AS DOUBLE) AS amount, currency,
       transaction_date, transaction_type, status
FROM transactions
""")
def s1(spark, sf_dir):
    """Typed CSV scan (header, empty field = NULL) of the transactions written as CSV."""
    L = ledger_for(spark, sf_dir)
    path = files.fresh_dir(spark, "s1-transactions-csv")
    files.write_csv(L.transactions, path)
    return files.read_csv(spark, path, "transactions")


@query("s2_idempotent_reload", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS row_count, COUNT(DISTINCT {PRIMARY_KEYS[t][0]}) AS key_count, "
    f"MIN({PRIMARY_KEYS[t][0]}) AS first_key, MAX({PRIMARY_KEYS[t][0]}) AS last_key FROM {t}" for t in LOAD_ORDER
))
def s2(spark, sf_dir):
    """Loading all six tables of a store twice leaves one copy of each (replaced, not appended)."""
    L = ledger_for(spark, sf_dir)
    folder, frames = files.fresh_dir(spark, "s2-reload"), []
    for t in LOAD_ORDER:
        key = PRIMARY_KEYS[t][0]
        files.reload(L.table(t), folder, t)
        again = files.reload(L.table(t), folder, t)
        # the table's keys are unique, so distinct keys are counted per key first
        per_key = again.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        frames.append(per_key.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.count(key).alias("key_count"), F.min(key).alias("first_key"), F.max(key).alias("last_key"),
        ).select(F.lit(t).alias("table_name"), "*"))
    return union_all(frames)


_COUNT_UNION = "\nUNION ALL\n".join(
    f"SELECT {i + 1} AS load_order, '{t}' AS table_name, COUNT(*) AS row_count FROM {t}"
    for i, t in enumerate(LOAD_ORDER)
)


@query("s3_ordered_load", _COUNT_UNION)
def s3(spark, sf_dir):
    """CSV dump of all six tables, loaded back parents first; rows per table as loaded."""
    L = ledger_for(spark, sf_dir)
    folder = files.fresh_dir(spark, "s3-load")
    paths = files.dump_csv(L.as_dict(), f"{folder}/csv")
    loaded = files.ordered_load(spark, paths, f"{folder}/parquet")
    counts = files.row_counts(loaded, "row_count")
    order = spark.createDataFrame([(i + 1, t) for i, t in enumerate(LOAD_ORDER)], "load_order long, table_name string")
    return order.join(F.broadcast(counts), "table_name").select("load_order", "table_name", "row_count")


@query("s4_row_count_reconcile", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS source_rows, COUNT(*) AS loaded_rows, TRUE AS matches FROM {t}"
    for t in LOAD_ORDER
))
def s4(spark, sf_dir):
    """Source and loaded row counts per table after a CSV round trip."""
    L = ledger_for(spark, sf_dir)
    folder = files.fresh_dir(spark, "s4-load")
    paths = files.dump_csv(L.as_dict(), f"{folder}/csv")
    loaded = files.ordered_load(spark, paths, f"{folder}/parquet")
    return files.reconcile(L.as_dict(), loaded)


def _spoilt(table: str) -> dict[str, str]:
    """column -> expression: some rows with another value, by the key."""
    (key,) = PRIMARY_KEYS[table]
    last = SCHEMAS[table].fields[-1].name
    return {f.name: f"CASE WHEN {key} % 101 = 7 THEN NULL ELSE {last} END" if f.name == last else f.name for f in SCHEMAS[table].fields}


def _content_sql(table: str) -> str:
    (key,) = PRIMARY_KEYS[table]
    spoilt = "SELECT " + ", ".join(f"{e} AS {c}" for c, e in _spoilt(table).items()) + f" FROM {table} WHERE {key} % 103 <> 5"
    more = f"SELECT * FROM {table} WHERE {key} % 107 = 3"
    return (f"SELECT '{table}' AS table_name, (SELECT COUNT(*) FROM (FROM {table} EXCEPT ALL ({spoilt} UNION ALL {more}))) AS only_source, "
            f"(SELECT COUNT(*) FROM (({spoilt} UNION ALL {more}) EXCEPT ALL FROM {table})) AS only_loaded")


@query("s4_content_reconcile", "\nUNION ALL\n".join(
    [f"SELECT '{t}' AS table_name, 0 AS only_source, 0 AS only_loaded" for t in LOAD_ORDER]
    + [f"SELECT 'spoilt ' || table_name AS table_name, only_source, only_loaded FROM ({_content_sql(t)})" for t in LOAD_ORDER]
))
def s4_contents(spark, sf_dir):
    """Contents per table after a CSV round trip, and against copies with lost, repeated and changed rows."""
    L = ledger_for(spark, sf_dir)
    folder = files.fresh_dir(spark, "s4-contents")
    paths = files.dump_csv(L.as_dict(), f"{folder}/csv")
    loaded = files.ordered_load(spark, paths, f"{folder}/parquet", on_step=files.dropping_staged(spark, paths))
    found = []
    for t, df in loaded.items():  # one table after the other: their plans and shuffles don't add up
        (key,) = PRIMARY_KEYS[t]
        changed = df.select(*[F.expr(e).alias(c) for c, e in _spoilt(t).items()]).where(f"{key} % 103 <> 5")
        spoilt = changed.unionByName(df.where(f"{key} % 107 = 3"))
        for name, rows in (("", df), ("spoilt ", spoilt)):
            found += [(name + r.table_name, r.only_source, r.only_loaded) for r in files.reconcile_contents({t: L.table(t)}, {t: rows}).collect()]  # one row
    return spark.createDataFrame(found, "table_name string, only_source long, only_loaded long")


@query("s5_csv_sink", """
SELECT settlement_id, transaction_id, settlement_date, CAST(settled_amount AS DOUBLE) AS settled_amount,
       CAST(processing_fee AS DOUBLE) AS processing_fee, status
FROM settlements
""")
def s5(spark, sf_dir):
    """CSV sink with a header, read back through the typed scan."""
    L = ledger_for(spark, sf_dir)
    path = files.fresh_dir(spark, "s5-settlements-csv")
    files.write_csv(L.settlements, path)
    return files.read_csv(spark, path, "settlements")


KPI_SQL = """
SELECT COUNT(transaction_id) AS total_tx_count,
       COALESCE(CAST(SUM(amount) AS DOUBLE), 0.0) AS total_tx_volume,
       COALESCE(CAST(SUM(amount) AS DOUBLE) / NULLIF(COUNT(transaction_id), 0), 0.0) AS avg_tx_value
FROM transactions
WHERE status = 'completed'
"""


@query("s6_sql_to_frame", KPI_SQL)
def s6(spark, sf_dir):
    """SQL text over temp views to a DataFrame (the dashboard's KPI query)."""
    prefix = ledger_for(spark, sf_dir).register_views()
    return spark.sql(KPI_SQL.replace("FROM transactions", f"FROM {prefix}transactions"))


@query("s7_first_row", KPI_SQL + "LIMIT 1")
def s7(spark, sf_dir):
    """The one-row result as a single record (``limit(1)``; ``first()`` on the driver)."""
    return trends.overview_kpis(ledger_for(spark, sf_dir).transactions).limit(1)


@query("s8_typed_tables", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{f.name}' AS column_name, '{f.dataType.simpleString()}' AS data_type, COUNT({f.name}) AS non_null_rows FROM {t}"
    for t in LOAD_ORDER for f in SCHEMAS[t].fields
))
def s8(spark, sf_dir):
    """Fixed schemas on read: all six tables through CSV and the conform step, type and values per column."""
    L = ledger_for(spark, sf_dir)
    folder, frames = files.fresh_dir(spark, "s8-csv"), []
    for t in LOAD_ORDER:
        files.write_csv(L.table(t), f"{folder}/{t}")
        df = conform(files.read_csv(spark, f"{folder}/{t}", t), t)
        rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(kind).alias("data_type"), F.count(c).alias("non_null_rows")) for c, kind in df.dtypes])
        frames.append(df.agg(rows.alias("r")).select(F.lit(t).alias("table_name"), F.inline("r")))
    return union_all(frames)


S9_MONTH = "1998-06-01"


@query("s9_date_partitioned_ledger", f"""
SELECT transaction_id, account_id, merchant_id, CAST(amount AS DOUBLE) AS amount, currency, transaction_date,
       transaction_type, status, CAST(date_trunc('month', transaction_date) AS DATE) AS transaction_month
FROM transactions
WHERE CAST(date_trunc('month', transaction_date) AS DATE) = DATE '{S9_MONTH}'
""")
def s9(spark, sf_dir):
    """Month-partitioned transactions; one month read with directory pruning."""
    L = ledger_for(spark, sf_dir)
    path = files.fresh_dir(spark, "s9-ledger-by-month")
    files.write_partitioned_ledger(L.transactions, path)
    return files.read_month(spark, path, S9_MONTH)


def _partials(spark, sf_dir):
    """Partials of the ledger by month, refreshed before and after one month's rows arrive late."""
    rows = ledger_for(spark, sf_dir).transactions
    root = files.fresh_dir(spark, "s9-partials")
    late = F.trunc("transaction_date", "MM") == F.lit(S9_MONTH).cast("date")
    files.write_partitioned_ledger(rows.where(~late | F.col("transaction_date").isNull()), f"{root}/ledger")
    kept = DailyPartials(spark, f"{root}/ledger", f"{root}/partials")
    kept.refresh()
    files.write_partitioned_ledger(rows.where(late), f"{root}/ledger", mode="append")
    return kept.refresh()


@query("s9_trends_from_partials", TRENDS)
def s9_trends(spark, sf_dir):
    """q2 merged from partials per month, of which only the changed month was computed anew."""
    return trends.monthly_trends_from_partials(_partials(spark, sf_dir))


@query("s9_rolling_from_partials", f"WITH {SERIES} SELECT * FROM series")
def s9_rolling(spark, sf_dir):
    """q7 merged from partials per month."""
    return rolling.rolling_from_daily(rolling.daily_totals_from_partials(_partials(spark, sf_dir)))


def _month_query(key: str, table: str, date_col: str, columns: str) -> None:
    month = files.month_column(date_col)

    @query(key, f"""
SELECT {columns}, CAST(date_trunc('month', {date_col}) AS DATE) AS {month}
FROM {table}
WHERE CAST(date_trunc('month', {date_col}) AS DATE) = DATE '{S9_MONTH}'
""")
    def build(spark, sf_dir):
        """One month of a table laid out by month, read with directory pruning."""
        path = files.fresh_dir(spark, f"s9-{table}-by-month")
        files.write_partitioned_ledger(ledger_for(spark, sf_dir).table(table), path, date_col, PRIMARY_KEYS[table][0])
        return files.read_month(spark, path, S9_MONTH, table, date_col)


_month_query("s9_settlements_by_month", "settlements", "settlement_date",
             "settlement_id, transaction_id, settlement_date, CAST(settled_amount AS DOUBLE) AS settled_amount, "
             "CAST(processing_fee AS DOUBLE) AS processing_fee, status")
_month_query("s9_flags_by_month", "fraud_flags", "flagged_date",
             "flag_id, transaction_id, flagged_date, flag_reason, is_resolved, resolved_date")
