"""Write PLANS.md: what the batch queries' executed plans hold.

``python tests/plan_report.py [SF_DIR]``. Each query is collected and its final
adaptive plan counted; the same with broadcasts off shows the joins at scale.
"""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from visitlens import registry  # noqa: E402
from visitlens.session import build_session  # noqa: E402

KINDS = {"scans": r"FileScan", "exchanges": r"(?<!Broadcast)Exchange \w*partitioning|Exchange SinglePartition", "reused": "ReusedExchange",
         "sort-merge joins": "SortMergeJoin", "broadcast joins": "BroadcastHashJoin", "object aggregates": "ObjectHashAggregate", "Expand": r"Expand \[",
         "pushed ts": r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts"}


def counts(spark, name, sf_dir):
    df = registry.queries()[name](spark, sf_dir)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("== Initial Plan ==")[0]
    return [len(re.findall(p, plan)) for p in KINDS.values()]


def main(sf_dir="/root/testdata/sf0.01"):
    spark = build_session("local[2]", shuffle_partitions=8)
    names = [n for n in registry.queries() if not n.startswith("st_")]
    out = ["# Executed plans", "", f"Counted in the final adaptive plans over {os.path.basename(sf_dir)} by `python tests/plan_report.py`;",
           "in brackets with broadcasts off, as for sides that are not small.", "", "| query | " + " | ".join(KINDS) + " |",
           "| --- |" + " --- |" * len(KINDS)]
    for n in names:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
        usual = counts(spark, n, sf_dir)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        large = counts(spark, n, sf_dir)
        out.append(f"| {n} | " + " | ".join(str(a) if a == b else f"{a} ({b})" for a, b in zip(usual, large)) + " |")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out) + "\n")
    spark.stop()


if __name__ == "__main__":
    main(*sys.argv[1:])
