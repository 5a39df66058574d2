"""Summarise the executed physical plans of registered queries.

usage: python tools/plan_summary.py [sf_dir] [name ...]
Prints a markdown table: shuffles, broadcasts, join kinds, aggregate kinds and
whether filters reached the Parquet scan.  Queries are executed (noop sink) so
the adaptive plan shown is the final one.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from changeledger.plans.registry import QUERIES  # noqa: E402
from changeledger.session import get_session  # noqa: E402


def summarize(plan: str) -> dict:
    return {
        "shuffles": len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|"
                                   r"Exchange RoundRobin|Exchange SinglePartition", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "joins": ",".join(sorted(set(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|"
                                                r"BroadcastNestedLoopJoin|CartesianProduct)", plan)))) or "-",
        "partial_agg": "yes" if "partial_" in plan else "-",
        "pushed": "yes" if re.search(r"PushedFilters: \[[^\]]+\]", plan) else "-",
    }


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")] or list(QUERIES)
    spark = get_session()
    print("| query | shuffles | broadcasts | joins | partial agg | pushed filters |")
    print("|---|---|---|---|---|---|")
    for n in names:
        df = QUERIES[n](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        s = summarize(df._jdf.queryExecution().executedPlan().toString())
        print(f"| `{n}` | {s['shuffles']} | {s['broadcasts']} | {s['joins']} | {s['partial_agg']} | {s['pushed']} |")
    spark.stop()


if __name__ == "__main__":
    main()
