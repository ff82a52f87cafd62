"""Dirty copies of the ledger tables, so that every audit meets violations.

Rows are changed by fixed rules on the primary key.  A rule is one SQL expression that
Spark and DuckDB read alike, so both sides audit the same dirty rows.  Primary keys
themselves stay (keys have natural violations in the driver tables).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.sources import schemas as S

# Times that break the windows of r2 and r7, and money that breaks r4 and the ranges.
_SPECIAL = {
    ("settlements", "settlement_date"): "WHEN {key} % 17 = 2 THEN settlement_date + INTERVAL 30 DAY",
    ("settlements", "settled_amount"): "WHEN {key} % 19 = 1 THEN CAST(-1 AS DECIMAL(15,2))",
    ("fraud_flags", "flagged_date"): "WHEN {key} % 17 = 3 THEN flagged_date - INTERVAL 9 DAY",
    ("transactions", "merchant_id"): "WHEN {key} % 19 = 4 THEN NULL",
}


def _expressions(table: str) -> dict[str, str]:
    """column -> expression; the key is unchanged."""
    (key,) = S.PRIMARY_KEYS[table]
    out = {}
    for i, c in enumerate(S.SCHEMAS[table].fieldNames()):
        cases = [_SPECIAL[table, c].format(key=key)] if (table, c) in _SPECIAL else []
        if c != key:
            if c in S.required_columns(table):
                cases.append(f"WHEN {key} % 13 = {i % 13} THEN NULL")
            if (table, c) in S.DOMAINS:
                cases.append(f"WHEN {key} % 11 = {i % 11} THEN 'bogus'")
            if (table, c) in S.LENGTHS:
                cases.append(f"WHEN {key} % 7 = {i % 7} THEN repeat('x', {S.LENGTHS[table, c] + 1})")
        out[c] = f"CASE {' '.join(cases)} ELSE {c} END" if cases else c
    return out


def dirty(table: str, df: DataFrame) -> DataFrame:
    return df.select(*[F.expr(e).alias(c) for c, e in _expressions(table).items()])


def dirty_sql(table: str) -> str:
    return "(SELECT " + ", ".join(f"{e} AS {c}" for c, e in _expressions(table).items()) + f" FROM {table})"


def too_large(table: str, columns: list[str]) -> dict[str, str]:
    """Money as doubles, some beyond NUMERIC(15,2)."""
    (key,) = S.PRIMARY_KEYS[table]
    return {c: f"CASE WHEN {key} % 7 = 1 THEN 1e13 + {key} ELSE CAST({c} AS DOUBLE) END" for c in columns}


def renamed(audit: DataFrame) -> DataFrame:
    """An audit's rows under the rule names of the dirty copy."""
    return audit.withColumn("rule", F.concat(F.lit("dirty "), "rule"))
