"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Derives and writes the ledger once (timed as ``ledger_build``), then runs
every headline query ``BENCH_REPEATS`` times (default 5) after
``BENCH_WARMUPS`` warm-up runs (default 2; the JVM compiles hot paths over
the first runs) and reports the median per query.  Execution is forced with the ``noop``
sink, so the full plan runs without collecting rows to the driver.
Prints one JSON line.  ``BENCH_ALL=1`` times every registered key instead
of the headline queries.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "q1_customer_segments",
    "q2_transaction_trends",
    "q3_merchant_performance",
    "q4_settlement_latency",
    "q5_risk_indicators",
    "q6_cohort_analysis",
    "q7_rolling_metrics",
    "q8_customer_lifetime_value",
    "q9_overview_kpis",
    "q10_monthly_trends",
    "q11_top_merchants",
    "q12_fraud_rate_by_category",
    "q13_cohort_retention_12m",
    "q14_cohort_matrix",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "5"))
    warmups = int(os.environ.get("BENCH_WARMUPS", "2"))

    from ledgerlens.plans.registry import queries
    from ledgerlens.session import get_session, input_bytes, settings_for_input
    from ledgerlens.sources.ledger import ledger_for

    # Partitioning sized from the input (see session.settings_for_input); the
    # checkpoint folder is the session's (spark.checkpoint.dir), the library
    # sets a local one only when none is configured.
    spark = get_session(master=f"local[{cpus}]")
    settings = settings_for_input(input_bytes(spark, sf_dir), cpus)
    if os.environ.get("BENCH_SHUFFLE_PARTITIONS"):
        settings["spark.sql.shuffle.partitions"] = os.environ["BENCH_SHUFFLE_PARTITIONS"]
    for key, value in settings.items():
        spark.conf.set(key, value)

    t0 = time.perf_counter()
    ledger_for(spark, sf_dir, fresh=True)  # derive and write a new copy: timed
    build = time.perf_counter() - t0

    qs = queries()
    times: dict[str, float] = {}
    keys = list(qs) if os.environ.get("BENCH_ALL") else HEADLINE
    for key in keys:
        df_fn = qs[key]
        for _ in range(warmups):  # JIT and plan-cache warm-up
            df_fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        runs = []
        for _ in range(repeats):
            t = time.perf_counter()
            df_fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t)
        times[key if os.environ.get("BENCH_ALL") else key.split("_")[0]] = round(statistics.median(runs), 4)

    total = round(sum(times.values()), 4)
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": total,
        "unit": "sec",
        "queries": times,
        "ledger_build_sec": round(build, 3),
        "build_and_queries_sec": round(build + total, 3),
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": cpus,
        "repeats": repeats,
        "warmups": warmups,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
