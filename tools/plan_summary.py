"""Summarise the physical plans of the headline queries (writes PLANS.md).

For each query: operator counts, join strategies with their keys, and the
parquet scans with pushed filters and read schema.  Plans are taken before
execution (AQE may still turn a sort-merge join into a broadcast join).
Usage: python tools/plan_summary.py [sf_dir]
"""

import collections
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from skulink.plans.queries import QUERIES  # noqa: E402
from skulink.session import get_spark  # noqa: E402

NAMES = ["jaccard_pairs", "cascade_none", "cascade_none_banded", "assisted_band", "multi_vendor",
         "consolidate_by_left", "listing_two_hop", "stopword_filter"]
OPS = ["SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
       "CartesianProduct", "HashAggregate", "ObjectHashAggregate", "SortAggregate", "Window",
       "Exchange hashpartitioning", "BroadcastExchange", "Generate", "Scan parquet",
       "Scan ExistingRDD"]


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", shuffle_partitions=8)
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `tools/plan_summary.py` on `{sf}`; plans before execution (AQE may",
           "still re-plan joins from runtime sizes). `Scan ExistingRDD` = a checkpointed reuse point.", ""]
    for name in NAMES:
        plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        counts = collections.Counter()
        for op in OPS:
            counts[op] = len(re.findall(re.escape(op), plan))
        out.append(f"## {name}")
        out.append("")
        out.append("operators: " + ", ".join(f"{k} x{v}" for k, v in counts.items() if v))
        joins = sorted({re.sub(r"#\d+L?", "", m) for m in
                        re.findall(r"(?:SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin) \[[^\]]*\], \[[^\]]*\], \w+", plan)})
        if joins:
            out.append("")
            out.append("joins (keys, type):")
            out += [f"- `{j}`" for j in joins]
        scans = sorted({re.sub(r"#\d+L?", "", line.strip())[:300] for line in plan.split("\n")
                        if "FileScan parquet" in line})
        if scans:
            out.append("")
            out.append("scans:")
            for sline in scans:
                pf = re.search(r"PushedFilters: (\[[^\]]*\])", sline)
                rs = re.search(r"ReadSchema: (struct<[^>]*>)", sline)
                tbl = re.search(r"FileScan parquet \[([^\]]*)\]", sline)
                out.append(f"- columns `{tbl.group(1) if tbl else '?'}`; pushed `{pf.group(1) if pf else '[]'}`"
                           + (f"; schema `{rs.group(1)}`" if rs else ""))
        out.append("")
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    print("\n".join(out)[:3000])


if __name__ == "__main__":
    main()
