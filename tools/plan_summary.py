"""Summarise the executed physical plan of every registered query.

Usage: python tools/plan_summary.py [sf_dir] > PLANS.md
Runs each query once (collect) so AQE has finalised its plan, then counts
scans, exchanges by kind, joins, windows, generators and Python stages.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from weekcast.queries import QUERIES  # noqa: E402
from weekcast.session import local_session, ship_package  # noqa: E402

SKIP = {"rf_pipeline", "rf_tuned", "trial_log", "forest_checks"}  # MLlib: many small jobs, no single plan
PATTERNS = {
    "scans": r"FileScan parquet|Scan parquet|Scan ExistingRDD",
    "hash exch": r"Exchange hashpartitioning",
    "range exch": r"Exchange rangepartitioning",
    "round-robin": r"Exchange RoundRobinPartitioning",
    "single-part": r"Exchange SinglePartition",
    "broadcast": r"BroadcastExchange",
    "BHJ": r"BroadcastHashJoin",
    "SMJ": r"SortMergeJoin",
    "window": r"\bWindow\b",
    "generate": r"\bGenerate\b",
    "top-k": r"TakeOrderedAndProject",
    "python": r"MapInPandas|ArrowEvalPython|FlatMapGroupsInPandas|BatchEvalPython",
}


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    ship_package(spark)
    cols = list(PATTERNS)
    print(f"# Executed plan shapes ({os.path.basename(sf)}, local[8], AQE on)\n")
    print("Counts of plan nodes after execution (final adaptive plan). Scans of checkpointed data show as"
          " `Scan ExistingRDD`; single-partition exchanges appear only under global aggregates of one row"
          " or of one row per partition.\n")
    print("| query | " + " | ".join(cols) + " |")
    print("|---" * (len(cols) + 1) + "|")
    for name, fn in QUERIES.items():
        if name in SKIP:
            continue
        df = fn(spark, sf)
        df.collect()  # run this DataFrame's own plan so AQE finalises it
        # the final adaptive plan prints the final and the initial plan: keep the final one
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        counts = [len(re.findall(PATTERNS[c], plan)) for c in cols]
        print(f"| {name} | " + " | ".join(str(c) if c else "" for c in counts) + " |")


if __name__ == "__main__":
    main()
