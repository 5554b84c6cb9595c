"""Summarise the physical plans of registered queries.

usage: python scripts/show_plans.py [--sf DIR] [key-substring ...]
For each query: exchanges (shuffles), join strategies, generators, Python
nodes, window nodes, scans with their pushed filters. Jobs that a query runs
while it is being built (checkpoints, size checks) are not shown: this is
the plan of the final DataFrame.
"""

from __future__ import annotations

import argparse
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from provisio.session import build_session  # noqa: E402

NODES = ("Exchange", "BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin", "BroadcastNestedLoopJoin",
         "ShuffledHashJoin", "CartesianProduct", "Window", "Generate", "MapInPandas", "ArrowEvalPython",
         "BatchEvalPython", "TakeOrderedAndProject", "HashAggregate", "ObjectHashAggregate", "SortAggregate")


def summary(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    counts = {n: len(re.findall(rf"\b{n}\b", plan)) for n in NODES}
    pushed = sorted(set(re.findall(r"PushedFilters: \[([^\]]*)\]", plan)) - {""})
    parts = [f"{n}={c}" for n, c in counts.items() if c]
    return ", ".join(parts) + (f"; pushed: {pushed}" if pushed else "")


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("--skip", default="", help="comma-separated key substrings to leave out")
    ap.add_argument("filters", nargs="*")
    args = ap.parse_args()
    from provisio.queries import queries

    spark = build_session("local[8]", 16)
    for key, fn in queries().items():
        if args.filters and not any(f in key for f in args.filters):
            continue
        if args.skip and any(f in key for f in args.skip.split(",")):
            continue
        try:
            print(f"{key}: {summary(fn(spark, args.sf))}")
        except Exception as e:  # noqa: BLE001
            print(f"{key}: ERROR {type(e).__name__}: {str(e)[:200]}")


if __name__ == "__main__":
    main()
