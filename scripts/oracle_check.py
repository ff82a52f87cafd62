"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

    python scripts/oracle_check.py [sf_dir] [key-prefix ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlens.plans.registry import oracle_sql, queries  # noqa: E402
from ledgerlens.plans.verify import compare, duck  # noqa: E402
from ledgerlens.session import get_session  # noqa: E402


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    prefixes = argv[2:]
    spark = get_session(shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for key, build in qs.items():
        if prefixes and not any(key.startswith(p) for p in prefixes):
            continue
        t0 = time.time()
        try:
            df = build(spark, sf_dir)
            if key not in sqls:
                print(f"NOSQL {key}: rows={df.count()}")
                continue
            ok, msg = compare(df, con, sqls[key])
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"error {type(e).__name__}: {str(e)[:300]}"
        bad += not ok
        print(f"{'ok   ' if ok else 'FAIL '} {key}: {msg} {time.time() - t0:.2f}s")
    print(f"failures: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
