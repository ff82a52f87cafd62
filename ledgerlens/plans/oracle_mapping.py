"""The ledger mapping of FIXTURES.md section 3 as DuckDB SQL.

Oracle queries run in DuckDB over the driver tables, so each one starts with
the CTEs of the ledger tables it reads.  ``ledger_sql(body)`` finds the table
names used in ``body`` and prepends their CTEs (with dependencies).
"""

from __future__ import annotations

import re

from ledgerlens.sources.fixtures import CATEGORIES, CURRENCY_CYCLE, FLAG_REASONS


def _list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


H = "(((transaction_id % 1000003) * 7919) % 1000003)"
G = "(((transaction_id % 999983) * 104729) % 999983)"


def extended_sql(key: str, number: str) -> str:
    """``key`` with ``number``'s two-digit groups and their number appended."""
    groups = f"CAST(ceil(length(CAST({number} AS VARCHAR)) / 2.0) AS BIGINT)"
    return f"(({key} * CAST(pow(100, {groups}) AS BIGINT) + {number}) * 10 + {groups})"


CTES: dict[str, str] = {
    "customers": """
SELECT c.c_custkey AS customer_id, c.c_name AS full_name,
       concat(lower(c.c_name), '@example.com') AS email,
       n.n_name AS country,
       CAST(DATE '1995-01-01' + CAST((c.c_custkey * 37) % 1460 AS INTEGER) AS DATE) AS join_date,
       CASE c.c_mktsegment WHEN 'MACHINERY' THEN 'business' WHEN 'FURNITURE' THEN 'premium'
            ELSE 'retail' END AS segment,
       c.c_acctbal > 0 AS is_active
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "accounts": f"""
SELECT customer_id * 2 + k AS account_id, customer_id,
       CASE WHEN customer_id % 20 < 12 THEN 'current' WHEN customer_id % 20 < 19 THEN 'savings'
            ELSE 'merchant' END AS account_type,
       ({_list(CURRENCY_CYCLE)})[((customer_id + k) % 5) + 1] AS currency,
       join_date AS opened_date,
       CASE WHEN (customer_id + k) % 100 < 92 THEN 'active' WHEN (customer_id + k) % 100 < 97 THEN 'closed'
            ELSE 'suspended' END AS status
FROM (SELECT customer_id, join_date,
             unnest(CASE WHEN customer_id % 5 = 0 THEN [0, 1] ELSE [0] END) AS k
      FROM customers) ck""",
    "merchants": f"""
SELECT s.s_suppkey AS merchant_id, s.s_name AS merchant_name,
       ({_list(CATEGORIES)})[(s.s_suppkey % 8) + 1] AS category,
       n.n_name AS country, DATE '1995-01-01' AS registration_date,
       CASE WHEN (s.s_suppkey * 7919) % 100 < 85 THEN 'low'
            WHEN (s.s_suppkey * 7919) % 100 < 97 THEN 'medium' ELSE 'high' END AS risk_tier
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey""",
    "transactions": f"""
SELECT transaction_id, account_id,
       CASE WHEN {G} % 100 < 85 THEN l_suppkey END AS merchant_id,
       CAST(l_extendedprice AS DECIMAL(15,2)) AS amount,
       currency,
       l_shipdate + to_seconds(date_diff('day', DATE '1995-01-01', opened_date) * 86400 + {H} % 86400) AS transaction_date,
       CASE WHEN {G} % 100 < 80 THEN 'purchase' WHEN {G} % 100 < 85 THEN 'refund'
            ELSE 'transfer' END AS transaction_type,
       CASE WHEN {H} % 100 < 90 THEN 'completed' WHEN {H} % 100 < 98 THEN 'failed'
            ELSE 'pending' END AS status
FROM (
  SELECT {extended_sql(extended_sql("l_orderkey", "l_linenumber"), "nth")} AS transaction_id,
         l_suppkey, l_extendedprice, l_shipdate, l_orderkey
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                     ORDER BY l_partkey, l_suppkey, l_shipdate, l_extendedprice,
                                              l_quantity, l_discount, l_tax) - 1 AS nth
        FROM lineitem) numbered) l
JOIN (
  SELECT o.o_orderkey,
         o.o_custkey * 2 + CASE WHEN o.o_custkey % 5 = 0 THEN o.o_orderkey % 2 ELSE 0 END AS account_id
  FROM orders o) o ON l.l_orderkey = o.o_orderkey
JOIN accounts a USING (account_id)""",
    "settlements": f"""
SELECT transaction_id AS settlement_id, transaction_id,
       transaction_date + to_seconds((1 + {H} % 5) * 86400 + ({G} % 24) * 3600 + ({G} % 60) * 60)
         AS settlement_date,
       CAST(greatest(amount - fee, 0) AS DECIMAL(15,2)) AS settled_amount,
       fee AS processing_fee,
       CASE WHEN {H} % 100 < 84 THEN 'settled' WHEN {H} % 100 < 89 THEN 'delayed'
            ELSE 'disputed' END AS status
FROM (
  SELECT t.transaction_id, t.transaction_date, t.amount,
         CAST(round(t.amount * CAST(CASE m.risk_tier
                WHEN 'high' THEN 350 + (((t.transaction_id % 1000003) * 7919) % 1000003) % 151
                WHEN 'medium' THEN 200 + (((t.transaction_id % 1000003) * 7919) % 1000003) % 101
                ELSE 100 + (((t.transaction_id % 1000003) * 7919) % 1000003) % 81 END AS INTEGER) * 0.0001, 2)
              AS DECIMAL(15,2)) AS fee
  FROM transactions t JOIN merchants m ON t.merchant_id = m.merchant_id
  WHERE t.status = 'completed' AND (((t.transaction_id % 999983) * 104729) % 999983) % 50 <> 0) s""",
    "fraud_flags": f"""
SELECT transaction_id AS flag_id, transaction_id, flagged_date,
       ({_list(FLAG_REASONS)})[({G} % 5) + 1] AS flag_reason,
       {G} % 10 < 8 AS is_resolved,
       CASE WHEN {G} % 10 < 8
            THEN flagged_date + to_seconds((1 + {G} % 7) * 86400 + ({G} % 24) * 3600) END AS resolved_date
FROM (SELECT transaction_id,
             transaction_date + to_seconds((({G}) % 4) * 3600 + (({G}) % 60) * 60) AS flagged_date
      FROM transactions WHERE {H} % 32 = 5) f""",
}

DEPENDS = {
    "customers": [],
    "accounts": ["customers"],
    "merchants": [],
    "transactions": ["accounts"],
    "settlements": ["transactions", "merchants"],
    "fraud_flags": ["transactions"],
}
ORDER = ["customers", "accounts", "merchants", "transactions", "settlements", "fraud_flags"]


def _needed(body: str) -> list[str]:
    want: set[str] = set()

    def add(name: str) -> None:
        if name not in want:
            want.add(name)
            for dep in DEPENDS[name]:
                add(dep)

    for name in ORDER:
        if re.search(rf"\b{name}\b", body):
            add(name)
    return [n for n in ORDER if n in want]


def ledger_sql(body: str) -> str:
    """Prefix ``body`` with the CTEs of the ledger tables it mentions.

    ``body`` may itself start with ``WITH``; its CTEs are appended after the
    ledger ones.
    """
    names = _needed(body)
    if not names:
        return body.strip()
    ctes = ",\n".join(f"{n} AS ({CTES[n]}\n)" for n in names)
    stripped = body.strip()
    if stripped[:4].upper() == "WITH":
        return f"WITH {ctes},\n{stripped[4:].lstrip()}"
    return f"WITH {ctes}\n{stripped}"
