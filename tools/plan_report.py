"""Summarise the physical plan of every batch query (after AQE, at the given scale).

Usage: python tools/plan_report.py [sf_dir]  -> markdown table on stdout
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, ".")


def summarise(df) -> dict:
    df.collect()               # run this DataFrame's own execution, so AQE settles its plan
    qe = df._jdf.queryExecution()
    p = qe.executedPlan().toString().split("== Initial Plan ==")[0]
    spread = len(re.findall(r"Exchange RoundRobinPartitioning", p))
    keyed = len(re.findall(r"Exchange (?:hashpartitioning|rangepartitioning|SinglePartition)", p))
    return {
        "shuffles": keyed,
        "spread": spread,
        "broadcasts": p.count("BroadcastExchange"),
        "joins": ", ".join(sorted(set(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin)", p)))) or "-",
        "aggregates": ", ".join(sorted(set(re.findall(r"(HashAggregate|SortAggregate|ObjectHashAggregate)", p)))) or "-",
        "window": "Window" in p,
        "pushed": sorted(set(re.findall(r"PushedFilters: \[([^\]]*)\]", p)) - {""}),
    }


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from transferlake.plans import batch
    from transferlake.session import build_session
    spark = build_session("local[8]", shuffle_partitions=16)
    print("| query | keyed shuffles | small-input spreads | broadcasts | joins | aggregates | window | pushed filters |")
    print("|---|---|---|---|---|---|---|---|")
    for name, fn in batch.QUERIES.items():
        s = summarise(fn(spark, sf_dir))
        pushed = "; ".join(x[:60] for x in s["pushed"]) or "-"
        print(f"| {name} | {s['shuffles']} | {s['spread']} | {s['broadcasts']} | {s['joins']} | {s['aggregates']} | "
              f"{'yes' if s['window'] else 'no'} | {pushed} |")


if __name__ == "__main__":
    main()
