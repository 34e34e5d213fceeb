"""Executed-plan facts for every query, as a markdown table.

    python tools/plan_audit.py [--sf-dir DIR] > PLANS.md

Each query is run once, so that the adaptive plan is the one that ran; its tree
is walked, subqueries included: Parquet scans and their pushed filters, shuffles,
reused exchanges, windows, joins, and Python nodes (there should be none).
"""

from __future__ import annotations

import argparse
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def nodes(plan) -> list:
    """Every node of an executed plan, once: stages and adaptive plans are
    entered at the plan that ran, subqueries through the expressions that hold
    them, and what is reused counts where it ran."""
    out, todo, seen = [], [plan], set()
    while todo:
        p = todo.pop()
        name = p.getClass().getSimpleName()
        if p.id() in seen:
            continue
        seen.add(p.id())
        if name == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
            continue
        out.append((name, p))
        if name.endswith("QueryStageExec"):
            todo.append(p.plan())
            continue
        if name.startswith("Reused"):
            continue
        for group in (p.children(), p.subqueries()):
            todo += [group.apply(i) for i in range(group.length())]
    return out


def facts(plan) -> dict:
    found = nodes(plan)
    count = lambda *names: sum(n in names for n, _ in found)
    scans = [p.simpleString(10000) for n, p in found if n == "FileSourceScanExec"]
    pushed = sorted({m for s in scans for m in re.findall(r"PushedFilters: \[([^\]]*)\]", s) if m})
    return {
        "scans": len(scans), "shuffles": count("ShuffleExchangeExec"),
        "reused": count("ReusedExchangeExec", "ReusedSubqueryExec"), "windows": count("WindowExec"),
        "bhj": count("BroadcastHashJoinExec"), "smj": count("SortMergeJoinExec"),
        "nlj": count("BroadcastNestedLoopJoinExec", "CartesianProductExec"),
        "python": sum(bool(re.search("Python|Pandas|Arrow", n)) for n, _ in found),
        "pushed": "; ".join(p[:110] for p in pushed if re.search("Than|Equal|In\\(", p))[:240],
    }


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("keys", nargs="*")
    args = ap.parse_args()
    from quillspark.plans.catalog import SQL_CHECKED
    from quillspark.session import local_session

    spark = local_session(8)
    queries = SQL_CHECKED
    print(f"# Executed plans ({args.sf_dir}, local[8], AQE on)\n")
    print("Counts are read from the final adaptive plan after the query ran (reused =")
    print("shuffle stages or subqueries AQE reused). Checkpoint jobs run before the main")
    print("plan, so their scans appear as RDD scans, not Parquet scans.\n")
    print("| query | sec | scans | shuffles | reused | windows | BHJ | SMJ | NLJ | Python | pushed filters |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for key in args.keys or list(queries):
        t0 = time.time()
        df = queries[key](spark, args.sf_dir)
        qe = df._jdf.queryExecution()
        qe.toRdd().count()                    # runs this plan (AQE finalises it)
        f = facts(qe.executedPlan())
        print(f"| {key} | {time.time() - t0:.1f} | {f['scans']} | {f['shuffles']} | {f['reused']} | "
              f"{f['windows']} | {f['bhj']} | {f['smj']} | {f['nlj']} | {f['python']} | {f['pushed']} |",
              flush=True)


if __name__ == "__main__":
    main()
