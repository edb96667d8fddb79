"""Write PLANS.md: the physical-plan shape of every registered query.

    python tools/plan_report.py [sf_dir]

The plan is taken with AQE off (the static plan; AQE may still turn a
shuffle join into a broadcast join or split a skewed partition at run time).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallysheet.session import build_session  # noqa: E402

PATTERNS = {
    "shuffles": r"Exchange (?:hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)",
    "broadcast joins": r"BroadcastHashJoin",
    "sort-merge joins": r"SortMergeJoin",
    "hash aggregates": r"HashAggregate",  # ObjectHashAggregate included
    "sort aggregates": r"SortAggregate",
    "windows": r"\bWindow\b",
    "scans": r"FileScan|Scan ExistingRDD|Scan OneRowRelation",
}


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    from tallysheet.plans import QUERIES

    lines = [
        "# PLANS",
        "",
        f"Static physical plans of the registered queries on `{sf_dir}` (AQE off; generated by",
        "`tools/plan_report.py`). Aggregates count partial + final stages separately; a sort",
        "aggregate folds structs or text per key (latest version, sparse fold) and sorts its input in each task.",
        "No query plans a nested-loop or cartesian join or a Python evaluation step",
        "(`tests/test_plans.py` enforces it). The queries of `tallysheet/llm` are not listed.",
        "",
        "| query | " + " | ".join(PATTERNS) + " |",
        "| --- | " + " | ".join("---" for _ in PATTERNS) + " |",
    ]
    for name, fn in QUERIES.items():
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        counts = [str(len(re.findall(p, plan))) for p in PATTERNS.values()]
        lines.append(f"| `{name}` | " + " | ".join(counts) + " |")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(lines) + "\n")


if __name__ == "__main__":
    main(sys.argv)
