"""Registry of named queries: key -> (Spark builder, DuckDB oracle SQL).

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame over the
ledger derived from ``sf_dir``.  The oracle body is plain SQL over the six
ledger table names; :func:`ledgerlens.plans.oracle_mapping.ledger_sql` adds
the CTEs that derive those tables from the driver tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.operators.common import report
from ledgerlens.plans.oracle_mapping import ledger_sql


@dataclass(frozen=True)
class Registered:
    key: str
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None
    doc: str


REGISTRY: dict[str, Registered] = {}


def query(key: str, oracle: str | None):
    """Register ``fn(spark, sf_dir) -> DataFrame``; its output goes through
    :func:`report` so both sides use the same reporting types."""

    def wrap(fn):
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            return report(fn(spark, sf_dir))

        build.__name__ = fn.__name__
        build.__doc__ = fn.__doc__
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")
        REGISTRY[key] = Registered(key, build, oracle, (fn.__doc__ or "").strip())
        return fn

    return wrap


def rr(num: str, den: str, digits: int) -> str:
    """DuckDB form of the exact half-up ratio (non-negative ``num``)."""
    scale = 10**digits
    return (
        f"(CAST((2 * CAST(({num}) AS HUGEINT) * {scale} + CAST(({den}) AS HUGEINT)) "
        f"// (2 * CAST(({den}) AS HUGEINT)) AS DOUBLE) / {scale}.0)"
    )


def rr_signed(num: str, den: str, digits: int) -> str:
    """Half away from zero for a numerator of either sign."""
    pos = rr(f"abs({num})", den, digits)
    return f"(CASE WHEN ({num}) >= 0 THEN {pos} ELSE -{pos} END)"


def age_months_sql(end: str, start: str) -> str:
    return f"CAST(date_part('year', age({end}, {start})) * 12 + date_part('month', age({end}, {start})) AS BIGINT)"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {k: r.build for k, r in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {k: ledger_sql(r.oracle) for k, r in REGISTRY.items() if r.oracle is not None}


def _load() -> None:
    # Importing the catalog modules registers their queries.
    from ledgerlens.plans import catalog_core, catalog_primitives, catalog_audits, catalog_io  # noqa: F401
