"""The driver contract in __spark_entry__.py."""

import importlib.util
import os

ENTRY = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")


def _module():
    spec = importlib.util.spec_from_file_location("spark_entry", ENTRY)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs_the_flagship_on_the_smallest_data(spark):
    df = _module().entry(spark)
    assert df.columns == ["cohort_month", "cohort_size", "months_active_offset", "active_customers",
                          "retention_rate", "prev_month_active_customers"]
    assert df.count() == 2826


def test_every_ledger_query_has_an_oracle():
    from ledgerlens.plans import registry

    mod = _module()
    assert set(registry.queries()) == set(registry.oracle_sql()) and len(registry.queries()) == 114
    assert set(registry.queries()) <= set(mod.queries()) and set(registry.oracle_sql()) <= set(mod.oracle_sql())
    assert set(mod.oracle_sql()) <= set(mod.queries())
