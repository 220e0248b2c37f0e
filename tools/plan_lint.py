"""Executed-plan lint for every registered query.

    python tools/plan_lint.py [--sf DIR] [name ...]

Per query: shuffle exchanges, single-partition exchanges (and what feeds
them), nested-loop / cartesian joins, Python evaluation nodes.  Run after the
query so that AQE's final plan is inspected.
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.plans import catalog  # noqa: E402
from tessera.session import get_session  # noqa: E402


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    spark = get_session()
    qs = catalog.queries()
    for name in args.names or sorted(qs):
        df = qs[name](spark, args.sf)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines = plan.splitlines()
        ex = sum(1 for l in lines if "Exchange hashpartitioning" in l or "Exchange rangepartitioning" in l)
        single = [i for i, l in enumerate(lines) if "Exchange SinglePartition" in l]
        feeds = []
        for i in single:
            nxt = lines[i + 1].strip(" :+-") if i + 1 < len(lines) else ""
            feeds.append(re.sub(r"\(.*", "", nxt)[:40])
        bad = [k for k in ("CartesianProduct", "BroadcastNestedLoopJoin") if k in plan]
        py = sum(1 for l in lines if "ArrowEvalPython" in l or "BatchEvalPython" in l or "MapInPandas" in l)
        print(f"{name:30s} shuffles={ex:2d} single={len(single)} {feeds} python={py} {' '.join(bad)}")
    spark.stop()


if __name__ == "__main__":
    main()
