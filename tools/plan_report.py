"""Tabulate the physical plan of every registered query of the catalog.

    python tools/plan_report.py [sf_dir] > PLANS.md

The plans are those of large data: adaptive execution and broadcast joins are
off, so every shuffle that the query needs is in the plan.  All nodes are
counted, those of scalar subqueries included.  Jobs that run while a query is
built (tables written to the scratch folder) are plans of their own and are
listed as "written first"."""

from __future__ import annotations

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from actlens.plans.catalog import QUERIES  # noqa: E402
from actlens.plans.session import build_session  # noqa: E402

COLUMNS = {
    "scans": lambda x: x.startswith("FileScan") or x.startswith("Scan "),
    "hash shuffles": lambda x: x.startswith("Exchange hash"),
    "range shuffles": lambda x: x.startswith("Exchange range"),
    "single": lambda x: x.startswith("Exchange Single"),
    "sort-merge joins": lambda x: x.startswith("SortMergeJoin"),
    "broadcast joins": lambda x: x.startswith("BroadcastHashJoin"),
    "nested loop, cartesian": lambda x: x.startswith(("BroadcastNestedLoopJoin", "CartesianProduct")),
    "windows": lambda x: x.startswith("Window"),
    "Python": lambda x: any(p in x.split("(")[0] for p in ("Python", "Pandas", "Arrow")),
}


def nodes(plan) -> list[str]:
    """Every node of a physical plan as text, scalar subqueries included."""
    out, todo = [], [plan]
    while todo:
        node = todo.pop()
        out.append(node.simpleString(200))
        for group in (node.children(), node.subqueries()):
            todo += [group.apply(i) for i in range(group.size())]
    return out


def main(sf_dir: str) -> None:
    folder = tempfile.mkdtemp(prefix="actlens-plans-")
    spark = build_session(app_name="actlens-plans", extra={
        "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.checkpoint.dir": folder})
    known: set[str] = set()
    print("# Physical plans of the catalog's queries\n")
    print(f"From `tools/plan_report.py` on `{sf_dir}`: {__doc__.split('<p>')[0].split(chr(10) * 2)[2].strip()}\n")
    print("| query | " + " | ".join(COLUMNS) + " | pushed filters | written first |")
    print("|---|" + "---|" * (len(COLUMNS) + 2))
    for name, fn in QUERIES.items():
        found = nodes(fn(spark, sf_dir)._jdf.queryExecution().executedPlan())
        written = sorted(x.rpartition("-")[0] for x in set(os.listdir(folder)) - known)
        known |= set(os.listdir(folder))
        pushed = [x for x in found if x.startswith("FileScan") and "events.parquet" in x]
        told = "-" if not pushed else "yes" if all("PushedFilters: [IsNotNull" in x for x in pushed) else "no"
        print(f"| {name} | " + " | ".join(str(sum(map(test, found))) for test in COLUMNS.values())
              + f" | {told} | {', '.join(written) or '-'} |")


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
