"""Read a DataFrame's physical plan: what the scans push down, which
exchanges and joins the planner chose.  Used by plan tests and for review."""

from __future__ import annotations

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The ``explain`` text of ``df`` (without printing it)."""
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def executed_plan_text(df: DataFrame) -> str:
    """The physical plan after running ``df`` (AQE's final plan)."""
    df.write.format("noop").mode("overwrite").save()
    return plan_text(df, "formatted")


def _depth(line: str) -> int:
    for i, ch in enumerate(line):
        if ch.isalnum() or ch == "*":
            return i
    return len(line)


def operators_above(plan: str, scan_marker: str) -> list[list[str]]:
    """For each scan line containing ``scan_marker`` in a ``simple`` plan,
    the operator lines from that scan up to the root (nearest first)."""
    lines = [ln for ln in plan.splitlines() if ln.strip()]
    chains = []
    for i, line in enumerate(lines):
        if "Scan" not in line or scan_marker not in line:
            continue
        chain, depth = [], _depth(line)
        for j in range(i - 1, -1, -1):
            d = _depth(lines[j])
            if d < depth:
                chain.append(lines[j].strip().lstrip("+-: ").strip())
                depth = d
        chains.append(chain)
    return chains
