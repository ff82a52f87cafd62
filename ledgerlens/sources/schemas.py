"""The six ledger tables: fixed schemas, value domains and a conform step (s8).

Keys are 64-bit (``LongType``); money is ``DecimalType(15, 2)``; event times are
zone-less timestamps.  Spark does not enforce ``VARCHAR(n)`` lengths, NOT NULL
or CHECK constraints on DataFrames, so those live here as data and are audited
by :mod:`ledgerlens.operators.integrity`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(15, 2)

CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.LongType(), False),
    T.StructField("full_name", T.StringType(), False),
    T.StructField("email", T.StringType(), False),
    T.StructField("country", T.StringType(), False),
    T.StructField("join_date", T.DateType(), False),
    T.StructField("segment", T.StringType(), False),
    T.StructField("is_active", T.BooleanType(), False),
])

ACCOUNTS = T.StructType([
    T.StructField("account_id", T.LongType(), False),
    T.StructField("customer_id", T.LongType(), False),
    T.StructField("account_type", T.StringType(), False),
    T.StructField("currency", T.StringType(), False),
    T.StructField("opened_date", T.DateType(), False),
    T.StructField("status", T.StringType(), False),
])

MERCHANTS = T.StructType([
    T.StructField("merchant_id", T.LongType(), False),
    T.StructField("merchant_name", T.StringType(), False),
    T.StructField("category", T.StringType(), False),
    T.StructField("country", T.StringType(), False),
    T.StructField("registration_date", T.DateType(), False),
    T.StructField("risk_tier", T.StringType(), False),
])

TRANSACTIONS = T.StructType([
    T.StructField("transaction_id", T.LongType(), False),
    T.StructField("account_id", T.LongType(), False),
    T.StructField("merchant_id", T.LongType(), True),
    T.StructField("amount", MONEY, False),
    T.StructField("currency", T.StringType(), False),
    T.StructField("transaction_date", T.TimestampNTZType(), False),
    T.StructField("transaction_type", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
])

SETTLEMENTS = T.StructType([
    T.StructField("settlement_id", T.LongType(), False),
    T.StructField("transaction_id", T.LongType(), False),
    T.StructField("settlement_date", T.TimestampNTZType(), False),
    T.StructField("settled_amount", MONEY, False),
    T.StructField("processing_fee", MONEY, False),
    T.StructField("status", T.StringType(), False),
])

FRAUD_FLAGS = T.StructType([
    T.StructField("flag_id", T.LongType(), False),
    T.StructField("transaction_id", T.LongType(), False),
    T.StructField("flagged_date", T.TimestampNTZType(), False),
    T.StructField("flag_reason", T.StringType(), False),
    T.StructField("is_resolved", T.BooleanType(), False),
    T.StructField("resolved_date", T.TimestampNTZType(), True),
])

SCHEMAS: dict[str, T.StructType] = {
    "customers": CUSTOMERS,
    "accounts": ACCOUNTS,
    "merchants": MERCHANTS,
    "transactions": TRANSACTIONS,
    "settlements": SETTLEMENTS,
    "fraud_flags": FRAUD_FLAGS,
}

# Parents before children: the order a load must follow (s3).
LOAD_ORDER = ["customers", "accounts", "merchants", "transactions", "settlements", "fraud_flags"]

PRIMARY_KEYS = {
    "customers": ["customer_id"],
    "accounts": ["account_id"],
    "merchants": ["merchant_id"],
    "transactions": ["transaction_id"],
    "settlements": ["settlement_id"],
    "fraud_flags": ["flag_id"],
}

UNIQUE_KEYS = {
    "customers": [["email"]],
    "settlements": [["transaction_id"]],
    "fraud_flags": [["transaction_id"]],
}

# (child, child column, parent, parent column, action on parent delete)
FOREIGN_KEYS = [
    ("accounts", "customer_id", "customers", "customer_id", "cascade"),
    ("transactions", "account_id", "accounts", "account_id", "cascade"),
    ("transactions", "merchant_id", "merchants", "merchant_id", "set null"),
    ("settlements", "transaction_id", "transactions", "transaction_id", "cascade"),
    ("fraud_flags", "transaction_id", "transactions", "transaction_id", "cascade"),
]

# Fixed values that must equal the source schema's declarations.
# CHECK (col IN (...)) lists:
DOMAINS = {
    ("customers", "segment"): ["retail", "business", "premium"],
    ("accounts", "account_type"): ["current", "savings", "merchant"],
    ("merchants", "risk_tier"): ["low", "medium", "high"],
    ("transactions", "transaction_type"): ["purchase", "refund", "transfer"],
    ("transactions", "status"): ["completed", "pending", "failed"],
    ("settlements", "status"): ["settled", "delayed", "disputed"],
}
# VARCHAR(n) limits:
LENGTHS = {
    ("customers", "full_name"): 100,
    ("customers", "email"): 100,
    ("customers", "country"): 100,
    ("customers", "segment"): 20,
    ("accounts", "account_type"): 20,
    ("accounts", "currency"): 3,
    ("accounts", "status"): 20,
    ("merchants", "merchant_name"): 100,
    ("merchants", "category"): 50,
    ("merchants", "country"): 100,
    ("merchants", "risk_tier"): 20,
    ("transactions", "currency"): 3,
    ("transactions", "transaction_type"): 20,
    ("transactions", "status"): 20,
    ("settlements", "status"): 20,
    ("fraud_flags", "flag_reason"): 255,
}
# CHECK range rules: (table, column, operator, bound)
RANGES = [
    ("transactions", "amount", ">", 0),
    ("settlements", "settled_amount", ">=", 0),
    ("settlements", "processing_fee", ">=", 0),
]
# NUMERIC(15,2) columns
NUMERIC_COLUMNS = [
    ("transactions", "amount"),
    ("settlements", "settled_amount"),
    ("settlements", "processing_fee"),
]


def required_columns(table: str) -> list[str]:
    """Columns declared NOT NULL (everything except the nullable ones)."""
    return [f.name for f in SCHEMAS[table].fields if not f.nullable]


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select the table's columns in order and cast each to its declared type.

    A pure projection: Catalyst folds it into the scan, so it costs nothing.
    ANSI casts raise on values that do not fit, as a typed load would.
    """
    schema = SCHEMAS[table]
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
