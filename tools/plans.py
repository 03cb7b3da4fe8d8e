"""Print condensed physical plans (operators, exchanges, scans) of registered queries.

Usage: python tools/plans.py [--scale] name [name ...]
``--scale`` disables static broadcast joins so the plan shows what Spark picks
when the tables are large (AQE still re-plans at run time).
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

KEEP = ("Exchange", "Sort", "Window", "WindowGroupLimit", "SortMergeJoin", "BroadcastHashJoin",
        "ShuffledHashJoin", "BroadcastNestedLoopJoin", "HashAggregate", "SortAggregate", "ObjectHashAggregate",
        "Expand", "Generate", "TakeOrderedAndProject", "Union")


def condensed(df) -> str:
    out = []
    for line in df._jdf.queryExecution().executedPlan().toString().split("\n"):
        m = re.match(r"^([\s:+\-|]*)(\*\(\d+\) )?(\w+)(.*)$", line)
        if not m:
            continue
        op, rest = m.group(3), m.group(4)
        if op in KEEP:
            detail = re.sub(r"#\d+L?", "", rest)
            detail = re.sub(r", \[plan_id=\d+\]", "", detail)
            out.append(f"{m.group(1)}{op}{detail[:110]}")
        elif op == "FileScan":
            cols = re.search(r"parquet \[([^\]]*)\]", rest)
            pushed = re.search(r"PushedFilters: \[([^\]]*)\]", rest)
            out.append(f"{m.group(1)}FileScan [{re.sub(r'#\d+L?', '', cols.group(1)) if cols else ''}]"
                       f" pushed=[{pushed.group(1)[:80] if pushed else ''}]")
    return "\n".join(out)


def main(argv: list[str]) -> None:
    from evhist.plans import catalog
    from evhist.session import build_session

    scale = "--scale" in argv
    names = [a for a in argv if not a.startswith("--")]
    extra = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"} if scale else {}
    spark = build_session("local[8]", 8, extra=extra)
    for name in names:
        print(f"### {name}\n```\n{condensed(catalog.REGISTRY[name](spark, '/root/testdata/sf0.01'))}\n```\n")


if __name__ == "__main__":
    main(sys.argv[1:])
