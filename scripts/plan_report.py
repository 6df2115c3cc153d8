"""Summarise the executed (adaptive, final) plan of every catalogue query.

Usage: python scripts/plan_report.py [sf_dir] > docs/PLANS.md
Counts shuffles, join strategies, aggregates, windows and Python UDFs, and
lists what reaches each Parquet scan (pushed filters, read schema).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from anemoi.plans.catalog import QUERIES  # noqa: E402
from anemoi.session import build_session  # noqa: E402

# operator nodes of the formatted explain: "(12) Exchange", one line per node
MARKS = {
    "scans": r"^\(\d+\) (Scan parquet|InMemoryTableScan)",
    "shuffles": r"^\(\d+\) Exchange",
    "broadcasts": r"^\(\d+\) BroadcastExchange",
    "broadcast joins": r"^\(\d+\) Broadcast(Hash|NestedLoop)Join",
    "sort-merge joins": r"^\(\d+\) SortMergeJoin",
    "hash aggregates": r"^\(\d+\) (Object)?HashAggregate",
    "sort aggregates": r"^\(\d+\) SortAggregate",
    "windows": r"^\(\d+\) Window",
    "python": r"^\(\d+\) (BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas)",
}


def count_final(fmt: str, pattern: str) -> int:
    """Count detail entries of nodes that belong to the final adaptive plans
    (the formatted text lists initial-plan nodes too)."""
    final = set()
    for block in re.findall(r"== Final Plan ==(.*?)(?:== Initial Plan ==|$)", fmt, re.S):
        final |= set(re.findall(r"\((\d+)\)", block))
    hits = 0
    for m in re.finditer(pattern, fmt, re.M):
        nid = re.match(r"\((\d+)\)", m.group(0)).group(1)
        hits += (not final) or nid in final
    return hits


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    print(f"# Executed plans of the catalogue queries ({os.path.basename(sf)})\n")
    print("Operator nodes of the final adaptive plans after a run (`scripts/plan_report.py`),")
    print("counted once each in the formatted explain, subqueries included. Small inputs make")
    print("AQE pick broadcasts that a large run would replace by shuffled joins.\n")
    print("| query | " + " | ".join(MARKS) + " |")
    print("| --- | " + " | ".join("---" for _ in MARKS) + " |")
    scans = {}
    for name, fn in QUERIES.items():
        df = fn(spark, sf)
        df.write.format("noop").mode("overwrite").save()
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        mode = spark.sparkContext._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        fmt = df._jdf.queryExecution().explainString(mode)
        counts = [count_final(fmt, p) for p in MARKS.values()]
        print(f"| {name} | " + " | ".join(str(c) for c in counts) + " |")
        found = set()
        for block in fmt.split("\n\n"):
            head = re.match(r"\((\d+)\) Scan parquet", block.strip())
            if not head:
                continue
            loc = re.search(r"Location: \S+ \[([^\]]*)\]", block)
            pushed = re.search(r"PushedFilters: \[(.*)\]", block)
            schema = re.search(r"ReadSchema: (struct<.*>)", block)
            found.add((os.path.basename(loc.group(1).split(",")[0]) if loc else "?",
                       pushed.group(1) if pushed and pushed.group(1) else "-",
                       schema.group(1) if schema else "?"))
        scans[name] = sorted(found)
    print("\n## Scans\n")
    for name, ss in scans.items():
        print(f"**{name}**\n")
        for loc, pushed, schema in ss:
            print(f"- `{loc}` pushed: `{pushed}` read: `{schema}`")
        print()
    spark.stop()


if __name__ == "__main__":
    main()
