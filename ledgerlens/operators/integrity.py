"""Schema constraints re-aimed as audits over whole tables (i1-i10).

Spark does not enforce NOT NULL, keys, CHECKs or foreign keys when it writes a
DataFrame, so each constraint is a job that counts violations.  Every audit
returns one row per rule, ``(rule, checked_rows, violations)``, so a clean
table still yields rows; ``*_rows`` variants return the offending rows.

Each audit is one scan with conditional counts, or one aggregation keyed on
the constrained columns (partial aggregation first, so a hot key collapses to
one row per task before the shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AUDIT_COLUMNS = ["rule", "checked_rows", "violations"]


def _explode_rules(agg: DataFrame, rules: list[tuple[str, str]], checked_col: str = "checked") -> DataFrame:
    """One row per (rule name, violation column) of a one-row aggregate."""
    items = [F.struct(F.lit(name).alias("rule"), F.col(c).cast("long").alias("violations")) for name, c in rules]
    return agg.select(F.col(checked_col).cast("long").alias("checked_rows"), F.explode(F.array(*items)).alias("r")).select(
        F.col("r.rule").alias("rule"), "checked_rows", F.col("r.violations").alias("violations")
    )


def conditional_counts(df: DataFrame, table: str, kind: str, conditions: dict[str, Column]) -> DataFrame:
    """Count rows violating each condition in one pass over ``df``."""
    aggs = [F.count(F.lit(1)).alias("checked")]
    rules = []
    for i, (name, cond) in enumerate(conditions.items()):
        aggs.append(F.count_if(F.coalesce(cond, F.lit(False))).alias(f"v{i}"))
        rules.append((f"{kind}:{table}.{name}", f"v{i}"))
    return _explode_rules(df.agg(*aggs), rules)


def not_null_audit(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """i1: NULLs in required columns."""
    return conditional_counts(df, table, "not_null", {c: F.col(c).isNull() for c in columns})


def domain_audit(df: DataFrame, table: str, domains: dict[str, list[str]]) -> DataFrame:
    """i4: values outside an IN list (NULL passes, as an SQL CHECK)."""
    return conditional_counts(df, table, "domain", {c: ~F.col(c).isin(*vals) for c, vals in domains.items()})


_OPS = {
    ">": lambda c, b: c > b,
    ">=": lambda c, b: c >= b,
    "<": lambda c, b: c < b,
    "<=": lambda c, b: c <= b,
}


def range_audit(df: DataFrame, table: str, checks: list[tuple[str, str, float]]) -> DataFrame:
    """i5: rows failing ``col op bound`` (NULL passes)."""
    return conditional_counts(
        df, table, "range", {f"{c}{op}{b}": ~_OPS[op](F.col(c), F.lit(b)) for c, op, b in checks}
    )


def length_audit(df: DataFrame, table: str, limits: dict[str, int]) -> DataFrame:
    """i7: text longer than its VARCHAR(n)."""
    return conditional_counts(df, table, "length", {f"{c}<={n}": F.length(c) > n for c, n in limits.items()})


def numeric_fit_audit(df: DataFrame, table: str, columns: list[str], precision: int = 15, scale: int = 2) -> DataFrame:
    """i8: values that do not fit NUMERIC(precision, scale) after rounding."""
    target = f"decimal({precision},{scale})"
    conds = {
        c: F.col(c).isNotNull() & F.expr(f"try_cast(round(`{c}`, {scale}) AS {target})").isNull() for c in columns
    }
    return conditional_counts(df, table, f"numeric({precision},{scale})", conds)


def key_audit(df: DataFrame, table: str, keys: list[str], *, nulls_allowed: bool, kind: str) -> DataFrame:
    """i2 / i3: duplicates (rows beyond the first per key) and, for primary
    keys, NULL keys.  One aggregation on the key columns."""
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).withColumn("null_key", any_null)
    dup = F.when(~F.col("null_key") & (F.col("n") > 1), F.col("n") - 1).otherwise(0)
    nulls = F.when(F.col("null_key"), F.col("n")).otherwise(0)
    violation = dup if nulls_allowed else dup + nulls
    agg = per_key.agg(F.sum("n").alias("checked"), F.sum(violation).alias("v"))
    name = f"{kind}:{table}({','.join(keys)})"
    return _explode_rules(agg.fillna(0), [(name, "v")])


def primary_key_audit(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    return key_audit(df, table, keys, nulls_allowed=False, kind="primary_key")


def unique_audit(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    return key_audit(df, table, keys, nulls_allowed=True, kind="unique")


def orphan_rows(child: DataFrame, parent: DataFrame, child_col: str, parent_col: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent (NULL keys pass)."""
    return child.where(F.col(child_col).isNotNull()).join(
        parent.select(F.col(parent_col).alias(child_col)), child_col, "left_anti"
    )


def foreign_key_audit(child: DataFrame, parent: DataFrame, child_table: str, child_col: str,
                      parent_table: str, parent_col: str) -> DataFrame:
    """i6: orphans.  Child keys are counted per key first, so a hot key is one
    row when it meets the parent keys."""
    keyed = child.groupBy(child_col).agg(F.count(F.lit(1)).alias("n"))
    parents = parent.select(F.col(parent_col).alias(child_col)).distinct().withColumn("_hit", F.lit(1))
    j = keyed.join(parents, child_col, "left")
    orphan = F.col(child_col).isNotNull() & F.col("_hit").isNull()
    agg = j.agg(F.sum("n").alias("checked"), F.sum(F.when(orphan, F.col("n")).otherwise(0)).alias("v"))
    name = f"foreign_key:{child_table}.{child_col}->{parent_table}.{parent_col}"
    return _explode_rules(agg.fillna(0), [(name, "v")])


# ---- offending rows (the second mode of the audits) ----------------------------

def null_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a NULL in any of ``columns`` (i1)."""
    cond = F.lit(False)
    for c in columns:
        cond = cond | F.col(c).isNull()
    return df.where(cond)


def domain_rows(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Rows whose ``column`` is outside ``values`` (NULL passes) (i4)."""
    return df.where(~F.col(column).isin(*values))


def range_rows(df: DataFrame, column: str, op: str, bound) -> DataFrame:
    """Rows failing ``column op bound`` (NULL passes) (i5)."""
    return df.where(~_OPS[op](F.col(column), F.lit(bound)))


def length_rows(df: DataFrame, column: str, limit: int) -> DataFrame:
    """Rows whose text is longer than ``limit`` (i7)."""
    return df.where(F.length(column) > limit)


def numeric_fit_rows(df: DataFrame, column: str, precision: int = 15, scale: int = 2) -> DataFrame:
    """Rows whose ``column`` doesn't fit NUMERIC(precision, scale) after rounding (i8)."""
    return df.where(F.col(column).isNotNull() & F.expr(f"try_cast(round(`{column}`, {scale}) AS decimal({precision},{scale}))").isNull())


def duplicate_key_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """All rows whose non-NULL key occurs more than once (i2, i3).

    The duplicated keys are found with one aggregation (partial counts first)
    and the rows are picked with a semi join; a key with a huge number of
    copies is one row of the key table, and the planner's skew handling
    splits its side of the semi join."""
    dup = (
        df.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
        .groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > 1)
        .select(*keys)
    )
    return df.join(dup, keys, "left_semi")


def union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# ---- deletes (i9, i10) ----------------------------------------------------------

def cascade_delete(tables: dict[str, DataFrame], doomed_customers: DataFrame | None = None,
                   doomed_accounts: DataFrame | None = None) -> dict[str, DataFrame]:
    """i9: remove customers (or accounts) and every dependant row (ON DELETE CASCADE).

    Each level is a left-anti join against the removed keys of its parent, so
    the removed key sets are derived, never collected."""
    customers, accounts = tables["customers"], tables["accounts"]
    gone_a = None
    if doomed_customers is not None:
        gone_c = doomed_customers.select("customer_id")
        gone_a = accounts.join(gone_c, "customer_id", "left_semi").select("account_id")
        customers = customers.join(gone_c, "customer_id", "left_anti")
        accounts = accounts.join(gone_c, "customer_id", "left_anti")
    if doomed_accounts is not None:
        own = doomed_accounts.select("account_id")
        accounts = accounts.join(own, "account_id", "left_anti")
        gone_a = own if gone_a is None else gone_a.unionByName(own)
    if gone_a is None:
        return dict(tables)
    gone_t = tables["transactions"].join(gone_a, "account_id", "left_semi").select("transaction_id")
    transactions = tables["transactions"].join(gone_a, "account_id", "left_anti")
    settlements = tables["settlements"].join(gone_t, "transaction_id", "left_anti")
    fraud_flags = tables["fraud_flags"].join(gone_t, "transaction_id", "left_anti")
    return {
        "customers": customers, "accounts": accounts, "merchants": tables["merchants"],
        "transactions": transactions, "settlements": settlements, "fraud_flags": fraud_flags,
    }


def set_null_delete(merchants: DataFrame, transactions: DataFrame, doomed_merchants: DataFrame) -> tuple[DataFrame, DataFrame]:
    """i10: remove merchants; their transactions stay with a NULL merchant
    (ON DELETE SET NULL).  Transactions without a merchant don't meet the join:
    they are one key, and can't match."""
    gone = doomed_merchants.select(F.col("merchant_id").alias("gone_id")).distinct()
    kept = merchants.join(gone, merchants.merchant_id == gone.gone_id, "left_anti")
    t = transactions.where(F.col("merchant_id").isNotNull()).join(gone, F.col("merchant_id") == F.col("gone_id"), "left")
    nulled = t.select(
        *[F.when(F.col("gone_id").isNull(), F.col(c)).alias(c) if c == "merchant_id" else F.col(c) for c in transactions.columns]
    )
    return kept, nulled.unionByName(transactions.where(F.col("merchant_id").isNull()))


def remaining_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, remaining_rows) for each table."""
    return union_all([
        df.agg(F.count(F.lit(1)).alias("remaining_rows")).select(F.lit(name).alias("table_name"), "remaining_rows")
        for name, df in tables.items()
    ])
