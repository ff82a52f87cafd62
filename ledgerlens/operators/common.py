"""Small building blocks shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def report(df: DataFrame) -> DataFrame:
    """Reporting types: exact decimals become the nearest double, small
    integers become 64-bit.  Everything else is left as it is."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        out.append(c.alias(f.name))
    return df.select(out)


def completed(transactions: DataFrame, status: str = "completed", status_col: str = "status") -> DataFrame:
    """p2: the status filter most queries start with (pushed to the scan)."""
    return transactions.where(F.col(status_col) == status)


def sort_keys(*keys) -> list[Column]:
    """Order keys with the reference database's NULL placement: NULLs last
    ascending, first descending.  Strings starting with '-' sort descending."""
    out = []
    for k in keys:
        if isinstance(k, str) and k.startswith("-"):
            out.append(F.col(k[1:]).desc_nulls_first())
        elif isinstance(k, str):
            out.append(F.col(k).asc_nulls_last())
        else:
            out.append(k)
    return out


def top_k_with_lookup(facts: DataFrame, dim: DataFrame, key: str, order: list[Column], k: int) -> DataFrame:
    """``facts ⋈ dim`` on ``key``, top ``k`` by ``order``: one lazy plan.

    ``facts`` has one row per key already, so the join moves one row per key and the
    planner broadcasts ``dim`` only if its measured size allows; the top k is a
    distributed one (k rows per task)."""
    return facts.join(dim, key).orderBy(*order).limit(k)
