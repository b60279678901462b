"""Count shuffles, broadcasts and base-table scans per query plan.

Usage: python tools/plan_stats.py [sf_dir]   (prints a markdown table)
"""

from __future__ import annotations

import os
import sys

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))

from basketlens.plans import queries  # noqa: E402
from basketlens.session import get_session  # noqa: E402


def stats(df) -> tuple[int, int, int]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    shuffles = sum(1 for ln in lines if "Exchange hashpartitioning" in ln or "Exchange rangepartitioning" in ln
                   or "Exchange SinglePartition" in ln or "Exchange RoundRobin" in ln)
    broadcasts = sum(1 for ln in lines if "BroadcastExchange" in ln)
    base_scans = sum(1 for ln in lines if "FileScan parquet" in ln and "tables/base-" in ln)
    return shuffles, broadcasts, base_scans


def reused(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("ReusedExchange")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    # static planning, so exchange reuse is applied and visible in the plan
    spark = get_session("local[8]", 8, extra={"spark.sql.adaptive.enabled": "false",
                                              "spark.ui.showConsoleProgress": "false"})
    print("| query | shuffles | broadcasts | base-table scans |")
    print("|---|---|---|---|")
    for name, fn in queries.QUERIES.items():
        s = stats(fn(spark, sf_dir))
        print(f"| {name} | {s[0]} | {s[1]} | {s[2]} |")
    spark.stop()


if __name__ == "__main__":
    main()
