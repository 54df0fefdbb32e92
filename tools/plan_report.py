"""Physical plans that large tables would get, for every registered library query (``docs/PLANS.md``).

Size-based broadcasting and adaptive execution are off, so every join shows the strategy
that does not depend on small inputs and every broadcast left is an explicit one. The
queries that cut heavy keys are listed twice: without a heavy key, and with every key
cut (``parley.skew.maxGroupRows`` = 3).
Usage: python tools/plan_report.py [sf_dir] > docs/PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

COLUMNS = ["scans", "shuffles", "reused", "explicit broadcasts", "joins", "windows", "top-k", "pushed", "python"]


def summarize(plan: str) -> dict[str, str]:
    def count(pattern: str) -> int:
        return len(re.findall(pattern, plan))
    joins = {k: n for k in ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
                            "CartesianProduct") if (n := count(rf"\b{k}\b"))}
    return {
        "scans": str(count("FileScan parquet")),
        "shuffles": str(count(r"\bExchange (?:hash|range|single|roundrobin|Single|RoundRobin)")),
        "reused": str(count("ReusedExchange")),
        "explicit broadcasts": str(count("BroadcastExchange")),
        "joins": ", ".join(f"{k}×{v}" for k, v in joins.items()) or "-",
        "windows": str(count(r"\bWindow \[")),
        "top-k": "yes" if ("TakeOrderedAndProject" in plan or "WindowGroupLimit" in plan) else "-",
        "pushed": "yes" if re.search(r"PushedFilters: \[[^\]]", plan) else "-",
        "python": "YES" if re.search(r"ArrowEvalPython|BatchEvalPython|InPandas|InArrow", plan) else "-",
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    from parley.plans.registry import QUERIES
    from parley.session import get_spark
    spark = get_spark("local[8]", 8, driver_memory="8g")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    print("# Physical plans of the registered queries\n")
    print("Generated by `tools/plan_report.py`: the plans for large tables (broadcasting by size and")
    print("adaptive execution off). `explicit broadcasts` are the cuts and carries of heavy keys, whose")
    print("number is bounded; `(heavy)` rows have every key cut.\n")
    print("| query | " + " | ".join(COLUMNS) + " |")
    print("| --- | " + " | ".join("---" for _ in COLUMNS) + " |")
    for name, fn in QUERIES.items():
        plans = []
        for limit in ("0", "3"):
            spark.conf.set("parley.skew.maxGroupRows", limit)
            plans.append(summarize(fn(spark, sf)._jdf.queryExecution().executedPlan().toString()))
        for label, s in zip((name, f"{name} (heavy)"), plans[:1] if plans[0] == plans[1] else plans):
            print(f"| {label} | " + " | ".join(s[c] for c in COLUMNS) + " |")


if __name__ == "__main__":
    main()
