"""Summarise the physical plan of every registered query.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
For each query: shuffles, partial per-group limits, partial aggregates,
broadcasts, sort-merge joins, scalar subqueries, and the columns each scan
reads. Plans are taken after execution, so AQE's final choices are shown.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def final_part(plan: str) -> str:
    """The plan without the initial plans of adaptive nodes, which repeat their operators."""
    kept, skipped = [], None
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :|"))
        if skipped is not None and depth > skipped:
            continue
        skipped = depth if "== Initial Plan ==" in line else None
        if skipped is None:
            kept.append(line)
    return "\n".join(kept)


def summarise(plan: str) -> dict[str, object]:
    plan = final_part(plan)
    scans = sorted(set(re.findall(r"ReadSchema: (struct<.*>)", plan)))
    return {
        "shuffles": len(re.findall(r"\bExchange (hash|range|SinglePartition|RoundRobin)", plan)),
        "single_task": len(re.findall(r"Exchange SinglePartition|TakeOrderedAndProject|CollectLimit", plan)),
        "reused": len(re.findall(r"Reused(Exchange|QueryStage)", plan)),
        "partial_group_limit": plan.count("row_number(), ") and len(re.findall(r"WindowGroupLimit.*Partial", plan)),
        "partial_aggregates": len(re.findall(r"partial_", plan)),
        "broadcast_joins": plan.count("BroadcastHashJoin"),
        "sort_merge_joins": plan.count("SortMergeJoin"),
        "scalar_subqueries": plan.count("Subquery subquery"),
        "python_udfs": plan.count("ArrowEvalPython") + plan.count("BatchEvalPython") + plan.count("MapInPandas"),
        "scans": scans,
    }


def main() -> None:
    root = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from postlytics.catalog import QUERIES
    from postlytics.session import get_session
    spark = get_session("local[8]", shuffle_partitions=8, **{
        "spark.sql.maxMetadataStringLength": "100000", "spark.sql.debug.maxToStringFields": "1000"})
    spark.sparkContext.setLogLevel("ERROR")
    print("# Physical plan summary\n")
    print(f"Generated by `python tools/plan_report.py {root}` (plans after execution, AQE final).\n")
    print("| Query | shuffles | single-task steps | reused | partial group limits | partial aggs | BHJ | SMJ | scalar subq | Python |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    scans = {}
    for name, build in QUERIES.items():
        df = build(spark, root)
        df.collect()  # runs through this DataFrame's own execution, so the AQE plan is final
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        scans[name] = s["scans"]
        print(f"| {name} | {s['shuffles']} | {s['single_task']} | {s['reused']} | {s['partial_group_limit']} | "
              f"{s['partial_aggregates']} | {s['broadcast_joins']} | {s['sort_merge_joins']} | "
              f"{s['scalar_subqueries']} | {s['python_udfs']} |")
    print("\n## Columns read per scan\n")
    for name, cols in scans.items():
        print(f"- **{name}**: " + ("; ".join(f"`{c}`" for c in cols) or "(no file scan in this plan)"))
    spark.stop()


if __name__ == "__main__":
    main()
