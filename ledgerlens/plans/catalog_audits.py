"""Integrity audits (i1-i10) and ledger rule audits (r1-r11).

Audits run over the derived ledger (clean: zero violations expected) and over
input that breaks their rule: driver tables with natural violations (FIXTURES.md
section 4) or dirty copies of the ledger tables (:mod:`ledgerlens.plans.dirty`).  The oracle
SQL is generated from the same rule specs as the Spark side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators import constraints as C
from ledgerlens.operators import integrity as I
from ledgerlens.operators import rules as R
from ledgerlens.operators.deletes import delete
from ledgerlens.plans.dirty import dirty, dirty_sql, renamed, too_large
from ledgerlens.plans.registry import query, rr
from ledgerlens.sources import schemas as S
from ledgerlens.sources.files import fresh_dir
from ledgerlens.sources.fixtures import read_driver
from ledgerlens.sources.generations import Store
from ledgerlens.sources.ledger import ledger_for

FEE_BANDS_BP = R.FEE_BANDS_BP


def _counts_sql(source: str, rules: dict[str, str]) -> str:
    """UNION ALL of one row per rule from one scan of ``source``."""
    parts = [
        f"SELECT '{name}' AS rule, CAST(COUNT(*) AS BIGINT) AS checked_rows, "
        f"CAST(COUNT(*) FILTER (WHERE COALESCE({cond}, FALSE)) AS BIGINT) AS violations FROM {source}"
        for name, cond in rules.items()
    ]
    return "\nUNION ALL\n".join(parts)


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(f"({p})" for p in parts)


# ---- i1 ------------------------------------------------------------------------

def _i1_sql() -> str:
    return _union([
        _counts_sql(source, {f"{name}not_null:{t}.{c}": f"{c} IS NULL" for c in S.required_columns(t)})
        for t in S.LOAD_ORDER for name, source in (("", t), ("dirty ", dirty_sql(t)))
    ])


@query("i1_not_null", _i1_sql())
def i1(spark, sf_dir):
    """NULLs in required columns of all six tables and of their dirty copies."""
    L = ledger_for(spark, sf_dir)
    audit = lambda t, df: I.not_null_audit(df, t, S.required_columns(t))
    return I.union_all([f for t in S.LOAD_ORDER for f in (audit(t, L.table(t)), renamed(audit(t, dirty(t, L.table(t)))))])


# ---- i2, i3 ----------------------------------------------------------------------

DIRTY_KEYS = [("lineitem", ["l_orderkey", "l_linenumber"])]
DIRTY_UNIQUE = [("part", ["p_name"])]


def _key_sql(table: str, keys: list[str], kind: str, nulls_allowed: bool) -> str:
    null_key = " OR ".join(f"{k} IS NULL" for k in keys)
    viol = "CASE WHEN NOT null_key AND n > 1 THEN n - 1 ELSE 0 END"
    if not nulls_allowed:
        viol = f"({viol} + CASE WHEN null_key THEN n ELSE 0 END)"
    return (
        f"SELECT '{kind}:{table}({','.join(keys)})' AS rule, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS checked_rows, "
        f"CAST(COALESCE(SUM({viol}), 0) AS BIGINT) AS violations "
        f"FROM (SELECT COUNT(*) AS n, ({null_key}) AS null_key FROM {table} GROUP BY {', '.join(keys)}) k"
    )


@query("i2_primary_key", _union(
    [_key_sql(t, k, "primary_key", False) for t, k in S.PRIMARY_KEYS.items()]
    + [_key_sql(t, k, "primary_key", False) for t, k in DIRTY_KEYS]
))
def i2(spark, sf_dir):
    """Primary keys unique and not NULL (ledger tables, and lineitem's non-unique pair)."""
    L = ledger_for(spark, sf_dir)
    frames = [C.key_audits(L.table(t), t, [("primary_key", k)]) for t, k in S.PRIMARY_KEYS.items()]
    frames += [C.key_audits(read_driver(spark, sf_dir, t, k), t, [("primary_key", k)]) for t, k in DIRTY_KEYS]
    return I.union_all(frames)


def _unique_specs():
    return [(t, k) for t, ks in S.UNIQUE_KEYS.items() for k in ks]


@query("i3_unique", _union(
    [_key_sql(t, k, "unique", True) for t, k in _unique_specs()]
    + [_key_sql(t, k, "unique", True) for t, k in DIRTY_UNIQUE]
))
def i3(spark, sf_dir):
    """UNIQUE columns (NULLs allowed): e-mail, one settlement / flag per transaction; part names."""
    L = ledger_for(spark, sf_dir)
    frames = [C.key_audits(L.table(t), t, [("unique", k) for k in keys]) for t, keys in S.UNIQUE_KEYS.items()]
    frames += [C.key_audits(read_driver(spark, sf_dir, t, k), t, [("unique", k)]) for t, k in DIRTY_UNIQUE]
    return I.union_all(frames)


# ---- i4 ------------------------------------------------------------------------

def _by_table(mapping: dict) -> dict[str, dict]:
    out: dict[str, dict] = {}
    for (t, c), v in mapping.items():
        out.setdefault(t, {})[c] = v
    return out


def _in_list(vals: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in vals) + ")"


@query("i4_domain_check", _union([
    _counts_sql(source, {f"{name}domain:{t}.{c}": f"{c} NOT IN {_in_list(v)}" for c, v in cols.items()})
    for t, cols in _by_table(S.DOMAINS).items() for name, source in (("", t), ("dirty ", dirty_sql(t)))
]))
def i4(spark, sf_dir):
    """CHECK (col IN (...)) lists, on the tables and their dirty copies; NULL passes."""
    L = ledger_for(spark, sf_dir)
    return I.union_all([f for t, cols in _by_table(S.DOMAINS).items() for f in (
        I.domain_audit(L.table(t), t, cols), renamed(I.domain_audit(dirty(t, L.table(t)), t, cols)))])


# ---- i5 ------------------------------------------------------------------------

DIRTY_RANGES = [("customer", "c_acctbal", ">=", 0)]


def _range_groups(specs):
    out: dict[str, list] = {}
    for t, c, op, b in specs:
        out.setdefault(t, []).append((c, op, b))
    return out


@query("i5_range_check", _union([
    _counts_sql(t, {f"range:{t}.{c}{op}{b}": f"NOT ({c} {op} {b})" for c, op, b in checks})
    for t, checks in _range_groups(S.RANGES + DIRTY_RANGES).items()
]))
def i5(spark, sf_dir):
    """amount > 0, settled / fee >= 0; customer balances >= 0 on the driver table."""
    L = ledger_for(spark, sf_dir)
    frames = []
    for t, checks in _range_groups(S.RANGES + DIRTY_RANGES).items():
        df = L.table(t) if t in S.SCHEMAS else read_driver(spark, sf_dir, t, [c for c, _, _ in checks])
        frames.append(I.range_audit(df, t, checks))
    return I.union_all(frames)


# ---- i6 ------------------------------------------------------------------------

def _fk_sql(child: str, ccol: str, parent_label: str, parent_sql: str, pcol: str) -> str:
    return (
        f"SELECT 'foreign_key:{child}.{ccol}->{parent_label}.{pcol}' AS rule, "
        f"CAST(COALESCE(SUM(k.n), 0) AS BIGINT) AS checked_rows, "
        f"CAST(COALESCE(SUM(CASE WHEN k.{ccol} IS NOT NULL AND p.hit IS NULL THEN k.n ELSE 0 END), 0) AS BIGINT) AS violations "
        f"FROM (SELECT {ccol}, COUNT(*) AS n FROM {child} GROUP BY {ccol}) k "
        f"LEFT JOIN (SELECT DISTINCT {pcol} AS key, 1 AS hit FROM {parent_sql}) p ON k.{ccol} = p.key"
    )


ACTIVE_ACCOUNTS = "accounts[status=active]"


@query("i6_foreign_key", _union(
    [_fk_sql(c, cc, p, p, pc) for c, cc, p, pc, _ in S.FOREIGN_KEYS]
    + [_fk_sql("transactions", "account_id", ACTIVE_ACCOUNTS,
               "(SELECT * FROM accounts WHERE status = 'active') aa", "account_id")]
))
def i6(spark, sf_dir):
    """Orphans per foreign key (NULL passes); also transactions against active accounts only."""
    L = ledger_for(spark, sf_dir)
    links: dict[str, list] = {}
    for child, column, parent, key, _ in S.FOREIGN_KEYS:
        links.setdefault(child, []).append((column, parent, L.table(parent), key))
    active = L.accounts.where(F.col("status") == "active")
    links["transactions"].append(("account_id", ACTIVE_ACCOUNTS, active, "account_id"))
    return I.union_all([C.foreign_key_audits(L.table(child), child, keys) for child, keys in links.items()])


# ---- i7, i8 ---------------------------------------------------------------------

@query("i7_length_check", _union([
    _counts_sql(source, {f"{name}length:{t}.{c}<={n}": f"length({c}) > {n}" for c, n in cols.items()})
    for t, cols in _by_table(S.LENGTHS).items() for name, source in (("", t), ("dirty ", dirty_sql(t)))
]))
def i7(spark, sf_dir):
    """VARCHAR(n) limits, on the tables and their dirty copies."""
    L = ledger_for(spark, sf_dir)
    return I.union_all([f for t, cols in _by_table(S.LENGTHS).items() for f in (
        I.length_audit(L.table(t), t, cols), renamed(I.length_audit(dirty(t, L.table(t)), t, cols)))])


DIRTY_NUMERIC = [("lineitem", "l_extendedprice"), ("orders", "o_totalprice"), ("customer", "c_acctbal")]


def _numeric_groups():
    out: dict[str, list] = {}
    for t, c in S.NUMERIC_COLUMNS + DIRTY_NUMERIC:
        out.setdefault(t, []).append(c)
    return out


@query("i8_numeric_fit", _union([
    _counts_sql(t, {f"numeric(15,2):{t}.{c}": f"{c} IS NOT NULL AND TRY_CAST(round({c}, 2) AS DECIMAL(15,2)) IS NULL"
                    for c in cols})
    for t, cols in _numeric_groups().items()
] + [
    _counts_sql("(SELECT " + ", ".join(f"{e} AS {c}" for c, e in too_large(t, cols).items()) + f" FROM {t})",
                {f"dirty numeric(15,2):{t}.{c}": f"{c} IS NOT NULL AND TRY_CAST(round({c}, 2) AS DECIMAL(15,2)) IS NULL" for c in cols})
    for t, cols in _numeric_groups().items() if t in S.SCHEMAS
]))
def i8(spark, sf_dir):
    """Values fit NUMERIC(15,2) (ledger money and the driver's double amounts)."""
    L = ledger_for(spark, sf_dir)
    frames = []
    for t, cols in _numeric_groups().items():
        df = L.table(t) if t in S.SCHEMAS else read_driver(spark, sf_dir, t, cols)
        frames.append(I.numeric_fit_audit(df, t, cols))
        if t in S.SCHEMAS:
            large = df.select(*[F.expr(e).alias(c) for c, e in too_large(t, cols).items()])
            frames.append(renamed(I.numeric_fit_audit(large, t, cols)))
    return I.union_all(frames)


# ---- i9, i10 --------------------------------------------------------------------

def _stored(spark, sf_dir: str, label: str) -> Store:
    """The ledger in a new store, in parts."""
    store = Store(spark, fresh_dir(spark, label))
    store.replace(ledger_for(spark, sf_dir).as_dict())
    return store


def _without_inactive_customers(spark, sf_dir: str) -> dict[str, DataFrame]:
    store = _stored(spark, sf_dir, "i9")
    delete(store, "customers", store.read("customers").where(~F.col("is_active")).select("customer_id"))
    return store.tables()


def _without_risky_merchants(spark, sf_dir: str) -> dict[str, DataFrame]:
    store = _stored(spark, sf_dir, "i10")
    delete(store, "merchants", store.read("merchants").where(F.col("risk_tier") == "high").select("merchant_id"))
    return store.tables()


@query("i9_cascade_delete", """
WITH gone_c AS (SELECT customer_id FROM customers WHERE NOT is_active),
gone_a AS (SELECT account_id FROM accounts WHERE customer_id IN (SELECT customer_id FROM gone_c)),
gone_t AS (SELECT transaction_id FROM transactions WHERE account_id IN (SELECT account_id FROM gone_a))
SELECT 'customers' AS table_name, COUNT(*) AS remaining_rows FROM customers WHERE customer_id NOT IN (SELECT customer_id FROM gone_c)
UNION ALL SELECT 'accounts', COUNT(*) FROM accounts WHERE customer_id NOT IN (SELECT customer_id FROM gone_c)
UNION ALL SELECT 'merchants', COUNT(*) FROM merchants
UNION ALL SELECT 'transactions', COUNT(*) FROM transactions WHERE account_id NOT IN (SELECT account_id FROM gone_a)
UNION ALL SELECT 'settlements', COUNT(*) FROM settlements WHERE transaction_id NOT IN (SELECT transaction_id FROM gone_t)
UNION ALL SELECT 'fraud_flags', COUNT(*) FROM fraud_flags WHERE transaction_id NOT IN (SELECT transaction_id FROM gone_t)
""")
def i9(spark, sf_dir):
    """ON DELETE CASCADE, written: remove inactive customers and all their dependants; rows left per table."""
    return I.remaining_counts(_without_inactive_customers(spark, sf_dir))


@query("i9_cascade_delete_accounts", """
WITH gone AS (SELECT account_id FROM accounts WHERE status = 'closed')
SELECT 'customers' AS table_name, COUNT(*) AS remaining_rows FROM customers
UNION ALL SELECT 'accounts', COUNT(*) FROM accounts WHERE account_id NOT IN (FROM gone)
UNION ALL SELECT 'merchants', COUNT(*) FROM merchants
UNION ALL SELECT 'transactions', COUNT(*) FROM transactions WHERE account_id NOT IN (FROM gone)
UNION ALL SELECT 'settlements', COUNT(*) FROM settlements JOIN transactions USING (transaction_id) WHERE account_id NOT IN (FROM gone)
UNION ALL SELECT 'fraud_flags', COUNT(*) FROM fraud_flags JOIN transactions USING (transaction_id) WHERE account_id NOT IN (FROM gone)
""")
def i9_accounts(spark, sf_dir):
    """ON DELETE CASCADE from accounts, written: remove closed accounts and all their dependants; rows left per table."""
    store = _stored(spark, sf_dir, "i9-accounts")
    delete(store, "accounts", store.read("accounts").where(F.col("status") == "closed").select("account_id"))
    return I.remaining_counts(store.tables())


@query("i10_set_null_delete", """
WITH gone AS (SELECT merchant_id FROM merchants WHERE risk_tier = 'high')
SELECT 'merchants' AS table_name, COUNT(*) AS remaining_rows FROM merchants WHERE merchant_id NOT IN (SELECT merchant_id FROM gone)
UNION ALL SELECT 'transactions', COUNT(*) FROM transactions
UNION ALL SELECT 'transactions.merchant_id_null',
  COUNT(*) FILTER (WHERE merchant_id IS NULL OR merchant_id IN (SELECT merchant_id FROM gone)) FROM transactions
""")
def i10(spark, sf_dir):
    """ON DELETE SET NULL, written: remove high-risk merchants; transactions stay with a NULL merchant."""
    left = _without_risky_merchants(spark, sf_dir)
    counts = I.remaining_counts({t: left[t] for t in ("merchants", "transactions")})
    nulls = left["transactions"].agg(F.count_if(F.col("merchant_id").isNull()).alias("remaining_rows")).select(
        F.lit("transactions.merchant_id_null").alias("table_name"), "remaining_rows")
    return counts.unionByName(nulls)


# table -> (own key, parent's key, a value) of the remaining rows
_ROWS = {
    "customers": ("customer_id", "NULL", "NULL"),
    "accounts": ("account_id", "customer_id", "NULL"),
    "merchants": ("merchant_id", "NULL", "NULL"),
    "transactions": ("transaction_id", "account_id", "CAST(amount AS DOUBLE)"),
    "settlements": ("settlement_id", "transaction_id", "CAST(settled_amount AS DOUBLE)"),
    "fraud_flags": ("flag_id", "transaction_id", "NULL"),
}


def _rows_sql(table: str, where: str = "TRUE") -> str:
    own, parent, value = _ROWS[table]
    merchant = "merchant_id" if table in ("merchants", "transactions") else "NULL"
    return (f"SELECT '{table}' AS table_name, {own} AS row_key, CAST({parent} AS BIGINT) AS parent_key, "
            f"CAST({merchant} AS BIGINT) AS merchant_key, CAST({value} AS DOUBLE) AS row_value FROM {table} WHERE {where}")


def _rows(tables: dict) -> DataFrame:
    frames = []
    for t, df in tables.items():
        own, parent, value = _ROWS[t]
        merchant = "merchant_id" if t in ("merchants", "transactions") else "NULL"
        frames.append(df.select(
            F.lit(t).alias("table_name"), F.col(own).alias("row_key"), F.expr(f"CAST({parent} AS BIGINT)").alias("parent_key"),
            F.expr(f"CAST({merchant} AS BIGINT)").alias("merchant_key"), F.expr(f"CAST({value} AS DOUBLE)").alias("row_value")))
    return I.union_all(frames)


@query("i9_remaining_rows", """
WITH gone_a AS (SELECT account_id FROM accounts JOIN customers USING (customer_id) WHERE NOT is_active),
gone_t AS (SELECT transaction_id FROM transactions WHERE account_id IN (FROM gone_a))
""" + _union([
    _rows_sql("customers", "is_active"),
    _rows_sql("accounts", "account_id NOT IN (FROM gone_a)"),
    _rows_sql("merchants"),
    _rows_sql("transactions", "account_id NOT IN (FROM gone_a)"),
    _rows_sql("settlements", "transaction_id NOT IN (FROM gone_t)"),
    _rows_sql("fraud_flags", "transaction_id NOT IN (FROM gone_t)"),
]))
def i9_rows(spark, sf_dir):
    """The rows that a written ON DELETE CASCADE from inactive customers leaves, read back from all six tables."""
    return _rows(_without_inactive_customers(spark, sf_dir))


@query("i10_remaining_rows", _union([
    _rows_sql("merchants", "risk_tier <> 'high'"),
    _rows_sql("transactions").replace("CAST(merchant_id AS BIGINT)", "CASE WHEN merchant_id NOT IN (SELECT merchant_id FROM merchants WHERE risk_tier = 'high') THEN merchant_id END"),
]))
def i10_rows(spark, sf_dir):
    """Merchants and transactions, read back after a written ON DELETE SET NULL from high-risk merchants."""
    left = _without_risky_merchants(spark, sf_dir)
    return _rows({t: left[t] for t in ("merchants", "transactions")})


# ---- r1-r11 ----------------------------------------------------------------------

def _rule_sql(name: str, source: str, cond: str, weight: str = "1") -> str:
    return (
        f"SELECT '{name}' AS rule, CAST(COALESCE(SUM({weight}), 0) AS BIGINT) AS checked_rows, "
        f"CAST(COALESCE(SUM(CASE WHEN COALESCE({cond}, FALSE) THEN {weight} ELSE 0 END), 0) AS BIGINT) AS violations "
        f"FROM {source}"
    )


@query("r1_temporal_order", _union([
    _rule_sql("temporal:account_opened>=customer_joined",
              "accounts a JOIN customers c ON a.customer_id = c.customer_id", "a.opened_date < c.join_date"),
    _rule_sql("temporal:transaction>=account_opened",
              "transactions t JOIN accounts a ON t.account_id = a.account_id",
              "CAST(t.transaction_date AS DATE) < a.opened_date"),
    _rule_sql("temporal:transaction>=merchant_registered",
              "transactions t JOIN merchants m ON t.merchant_id = m.merchant_id",
              "CAST(t.transaction_date AS DATE) < m.registration_date"),
    _rule_sql("temporal:lineitem.l_shipdate>=orders.o_orderdate",
              "lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey", "l.l_shipdate < o.o_orderdate"),
]))
def r1(spark, sf_dir):
    """Dates in order: join <= opened <= transaction; registration <= transaction; order <= ship (driver)."""
    L = ledger_for(spark, sf_dir)
    return I.union_all([
        R.temporal_order(L.customers, L.accounts, L.merchants, L.transactions),
        R.ship_after_order(read_driver(spark, sf_dir, "lineitem", ["l_orderkey", "l_shipdate"]),
                           read_driver(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate"])),
    ])


SETTLED = "settlements s JOIN transactions t ON s.transaction_id = t.transaction_id"
DIRTY_SETTLED = f"{dirty_sql('settlements')} s JOIN {dirty_sql('transactions')} t ON s.transaction_id = t.transaction_id"
SECS = "(epoch(s.settlement_date) - epoch(t.transaction_date))"


def _clean_and_dirty(L, tables: tuple[str, ...], audit):
    """``audit`` of the tables and of their dirty copies."""
    clean = [L.table(t) for t in tables]
    return audit(*clean).unionByName(renamed(audit(*[dirty(t, df) for t, df in zip(tables, clean)])))


@query("r2_settlement_window", _union([
    _rule_sql(f"{name}window:settlement_in[1d,6d)", source, f"{SECS} < 86400 OR {SECS} >= 518400")
    for name, source in (("", SETTLED), ("dirty ", DIRTY_SETTLED))
]))
def r2(spark, sf_dir):
    """Settled at least one day and less than six days after the transaction."""
    return _clean_and_dirty(ledger_for(spark, sf_dir), ("settlements", "transactions"), R.settlement_window)


def _bp_sql(i: int) -> str:
    return ("CASE m.risk_tier " + " ".join(f"WHEN '{t}' THEN {b[i]}" for t, b in FEE_BANDS_BP.items() if t != "low")
            + f" ELSE {FEE_BANDS_BP['low'][i]} END")


@query("r3_fee_band", _rule_sql(
    "fee_band:processing_fee/amount_in_tier_band",
    f"{SETTLED} JOIN merchants m ON t.merchant_id = m.merchant_id",
    f"CAST(s.processing_fee * 100 AS HUGEINT) * 10000 < CAST(t.amount * 100 AS HUGEINT) * ({_bp_sql(0)}) - 5000 "
    f"OR CAST(s.processing_fee * 100 AS HUGEINT) * 10000 > CAST(t.amount * 100 AS HUGEINT) * ({_bp_sql(1)}) + 5000",
))
def r3(spark, sf_dir):
    """Fee / amount inside the merchant tier's band (half a cent tolerance)."""
    L = ledger_for(spark, sf_dir)
    return R.fee_band(L.settlements, L.transactions, L.merchants)


@query("r4_settlement_balance", _union([_counts_sql(source, {
    f"{name}balance:settled_amount=greatest(amount-fee,0)":
        "s.settled_amount <> CASE WHEN t.amount - s.processing_fee > 0 OR t.amount - s.processing_fee IS NULL "
        "THEN coalesce(t.amount - s.processing_fee, 0) ELSE 0 END",
    f"{name}balance:settled_amount>=0": "s.settled_amount < 0",
}) for name, source in (("", SETTLED), ("dirty ", DIRTY_SETTLED))]))
def r4(spark, sf_dir):
    """settled + fee = amount (floored at zero)."""
    return _clean_and_dirty(ledger_for(spark, sf_dir), ("settlements", "transactions"), R.settlement_balance)


@query("r5_merchant_presence", _union([
    _rule_sql(f"{name}presence:merchant_null<=>transfer", source, "(merchant_id IS NULL) <> (transaction_type = 'transfer')")
    for name, source in (("", "transactions"), ("dirty ", dirty_sql("transactions")))
]))
def r5(spark, sf_dir):
    """The merchant is NULL exactly for transfers."""
    return _clean_and_dirty(ledger_for(spark, sf_dir), ("transactions",), R.merchant_presence)


@query("r6_currency_match", _rule_sql("currency:transaction=account",
                                      "transactions t JOIN accounts a ON t.account_id = a.account_id",
                                      "t.currency <> a.currency"))
def r6(spark, sf_dir):
    """Transaction currency equals the account's currency."""
    L = ledger_for(spark, sf_dir)
    return R.currency_match(L.transactions, L.accounts)


_FD = "(epoch(f.flagged_date) - epoch(t.transaction_date))"
_RD = "(epoch(f.resolved_date) - epoch(f.flagged_date))"


@query("r7_flag_timing", _union([_counts_sql(source, {
    f"{name}flag:flagged_in[0h,4h)": f"{_FD} < 0 OR {_FD} >= 14400",
    f"{name}flag:resolved_date<=>is_resolved": "(f.resolved_date IS NOT NULL) <> f.is_resolved",
    f"{name}flag:resolved_in[1d,8d)": f"f.is_resolved AND ({_RD} < 86400 OR {_RD} >= 691200)",
}) for name, source in (
    ("", "fraud_flags f JOIN transactions t ON f.transaction_id = t.transaction_id"),
    ("dirty ", f"{dirty_sql('fraud_flags')} f JOIN {dirty_sql('transactions')} t ON f.transaction_id = t.transaction_id"))]))
def r7(spark, sf_dir):
    """Flag 0 to < 4 h after; resolved date exactly when resolved, 1 to < 8 days later."""
    return _clean_and_dirty(ledger_for(spark, sf_dir), ("fraud_flags", "transactions"), R.flag_timing)


@query("r8_settlement_backlog", """
SELECT m.category, COUNT(*) AS backlog_transactions
FROM transactions t JOIN merchants m ON t.merchant_id = m.merchant_id
WHERE t.status = 'completed'
  AND NOT EXISTS (SELECT 1 FROM settlements s WHERE s.transaction_id = t.transaction_id)
GROUP BY m.category
""")
def r8(spark, sf_dir):
    """Completed merchant transactions still without a settlement, per category."""
    L = ledger_for(spark, sf_dir)
    return R.settlement_backlog(L.transactions, L.settlements, L.merchants)


@query("r9_fixed_size_sample", """
SELECT transaction_id, CAST(amount AS DOUBLE) AS amount, status FROM transactions
ORDER BY (transaction_id * 7919) % 1000003, transaction_id LIMIT 1000
""")
def r9(spark, sf_dir):
    """A repeatable sample of 1,000 transactions without replacement."""
    t = ledger_for(spark, sf_dir).transactions
    return R.fixed_size_sample(t, "transaction_id", 1000).select("transaction_id", "amount", "status")


@query("r10_account_coverage", _union([
    _rule_sql("coverage:customers->accounts",
              "customers c LEFT JOIN (SELECT DISTINCT customer_id AS k, 1 AS hit FROM accounts) a ON c.customer_id = a.k",
              "a.hit IS NULL"),
    _rule_sql("coverage:orders->lineitem",
              "orders o LEFT JOIN (SELECT DISTINCT l_orderkey AS k, 1 AS hit FROM lineitem) l ON o.o_orderkey = l.k",
              "l.hit IS NULL"),
]))
def r10(spark, sf_dir):
    """Every customer has an account; every order has a line (driver tables, naturally dirty)."""
    L = ledger_for(spark, sf_dir)
    return I.union_all([
        R.coverage(L.customers, L.accounts, "customer_id", "customer_id", "coverage:customers->accounts"),
        R.coverage(read_driver(spark, sf_dir, "orders", ["o_orderkey"]),
                   read_driver(spark, sf_dir, "lineitem", ["l_orderkey"]),
                   "o_orderkey", "l_orderkey", "coverage:orders->lineitem"),
    ])


PROFILES = [
    ("customers", "segment"), ("merchants", "risk_tier"),
    ("transactions", "transaction_type"), ("transactions", "status"),
]


def _profile_sql(t: str, c: str) -> str:
    return (
        f"SELECT '{t}.{c}' AS profile, {c} AS value, COUNT(*) AS row_count, "
        f"{rr('COUNT(*) * 100', f'(SELECT COUNT(*) FROM {t})', 2)} AS share_pct FROM {t} GROUP BY {c}"
    )


@query("r11_share_profile", _union([_profile_sql(t, c) for t, c in PROFILES]))
def r11(spark, sf_dir):
    """Share of each value: segment, risk tier, transaction type and status."""
    L = ledger_for(spark, sf_dir)
    return I.union_all([R.share_profile(L.table(t), c, f"{t}.{c}") for t, c in PROFILES])
