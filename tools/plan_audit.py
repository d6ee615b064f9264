"""Physical-plan audit of every SQL-checked plan: shuffles, broadcasts, scans.

usage: python tools/plan_audit.py [sf_dir] > PLANS.md
Counts operators in the executed plan after a run (AQE final plan).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from periodfact.plans import queries  # noqa: E402
from periodfact.plans.oracle import oracle_sql  # noqa: E402
from periodfact.session import get_session  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=8)
    qs = queries()
    print("# Physical plans\n")
    print(f"Final AQE plans of the SQL-checked plans at `{sf}` (generated by "
          "`tools/plan_audit.py`). Shuffles = hash/range/single-partition exchanges "
          "(reused ones not counted); scans include the re-reads of files a plan "
          "writes itself.\n")
    print("| Plan | Shuffles | Broadcasts | Scans | Sort aggregates | Sort-merge joins | Windows | Python |")
    print("|---|---|---|---|---|---|---|---|")
    for name in oracle_sql():
        df = qs[name](spark, sf)
        df.write.format("noop").mode("overwrite").save()
        p = df._jdf.queryExecution().executedPlan().toString()
        ex = len(re.findall(r"\+- Exchange (hash|range)partitioning|\+- Exchange SinglePartition", p))
        row = [ex, p.count("BroadcastExchange"), len(re.findall(r"FileScan|Scan ExistingRDD", p)),
               p.count("SortAggregate"), p.count("SortMergeJoin"), len(re.findall(r"\bWindow ", p)),
               len(re.findall(r"PythonUDF|EvalPython|MapInPandas|PythonMapInArrow", p))]
        print(f"| `{name}` | " + " | ".join(str(x) for x in row) + " |", flush=True)


if __name__ == "__main__":
    main()
