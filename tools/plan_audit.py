"""Summarise the physical plan of every registered query.

For each query: hash / range / single-partition exchanges, broadcasts,
windows, scalar subqueries, scans with pushed filters and their read
schemas, and whether any Python evaluation node appears. Prints a markdown
table (used for PLANS.md). Usage: python tools/plan_audit.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from adsentry.session import build_session  # noqa: E402


def audit(plan: str) -> dict[str, int | str]:
    main, _, subs = plan.partition("===== Subqueries =====")
    count = lambda pat, text: len(re.findall(pat, text))
    scans = re.findall(r"ReadSchema: ([^\n]*)", plan)
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", plan)
    return {
        "hash_ex": count(r"Arguments: hashpartitioning", main),
        "range_ex": count(r"Arguments: rangepartitioning", main),
        "single_ex": count(r"Arguments: SinglePartition", main),
        "bcast": count(r"\) BroadcastExchange", plan),
        "windows": count(r"\) Window\b", plan),
        "subqueries": len(set(re.findall(r"Subquery subquery#(\d+)", plan))),
        "sub_exchanges": count(r"Arguments: (hashpartitioning|rangepartitioning|SinglePartition)", subs),
        "scans": len(scans),
        "ckpt_reads": count(r"Scan ExistingRDD", plan),
        "pushed": sum(1 for p in pushed if p.strip()),
        "cols_read": max((s.count(":") for s in scans), default=0),
        "python": int(bool(re.search(r"(BatchEvalPython|ArrowEvalPython|PythonUDF)", plan))),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    from adsentry.catalog import QUERIES

    cols = ["hash_ex", "range_ex", "single_ex", "bcast", "windows", "subqueries", "sub_exchanges", "scans",
            "ckpt_reads", "pushed", "cols_read", "python"]
    print("| query | " + " | ".join(cols) + " |")
    print("| --- | " + " | ".join("---" for _ in cols) + " |")
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        a = audit(plan)
        print(f"| `{name}` | " + " | ".join(str(a[c]) for c in cols) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
