"""Summarise the physical plans of the headline queries (after execution, so
AQE's final plan is shown): shuffles, broadcasts, join strategies, pushed
filters and read schemas per scan.

    python tools/plan_report.py [--sf-dir DIR] [name ...]  > PLANS.md
"""

from __future__ import annotations

import argparse
import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def final_tree(plan: str) -> str:
    """The operator tree of the final adaptive plan (or the only plan)."""
    tree = plan.split("\n\n")[0]
    if "== Final Plan ==" in tree:
        tree = tree.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
    return tree


def summarise(plan: str) -> dict:
    ops = re.findall(r"([A-Za-z][A-Za-z ]*?) \(\d+\)", final_tree(plan))
    ops = [o.strip() for o in ops]
    count = lambda pat: sum(1 for o in ops if re.match(pat, o))
    pushed = list(dict.fromkeys(re.findall(r"PushedFilters: \[(.*)\]", plan)))
    schemas = list(dict.fromkeys(re.findall(r"ReadSchema: struct<(.*)>", plan)))
    return {
        "shuffles": count(r"^Exchange$"), "reused_shuffles": count(r"^ReusedExchange$"),
        "broadcasts": count(r"^BroadcastExchange$"), "bhj": count(r"^BroadcastHashJoin"),
        "smj": count(r"^SortMergeJoin"), "bnlj": count(r"^BroadcastNestedLoopJoin"),
        "hash_aggs": count(r"^HashAggregate$"), "sorts": count(r"^Sort$"), "python": count(r"^(ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|MapInPandas)"),
        "pushed": [p for p in pushed if p], "schemas": schemas,
    }


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    from bench import HEADLINE
    from kpiloom.session import get_session
    from kpiloom.workloads import load_all
    spark = get_session(master="local[8]", shuffle_partitions=8)
    reg = load_all()
    print(f"# Physical plans of the headline queries ({os.path.basename(args.sf_dir)}, final AQE plans)\n")
    print("Generated by `tools/plan_report.py`. Counts are operators in the executed plan; "
          "`python` counts Python/pandas evaluation nodes (all zero = everything runs in the JVM).\n")
    print("| query | shuffles | reused | broadcasts | BHJ | SMJ | BNLJ | hash aggs | sorts | python |")
    print("|---|---|---|---|---|---|---|---|---|---|")
    details = []
    for name in args.names or HEADLINE:
        df = reg[name][0](spark, args.sf_dir)
        df.collect()                      # run it, so explain shows the final adaptive plan
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        text = buf.getvalue()
        final = "isFinalPlan=true" in text
        s = summarise(text)
        label = "" if final else (" (no exchange: not adaptive)" if "AdaptiveSparkPlan" not in text else " (initial plan)")
        print(f"| {name}{label} | {s['shuffles']} | {s['reused_shuffles']} | {s['broadcasts']} | {s['bhj']} | {s['smj']} | "
              f"{s['bnlj']} | {s['hash_aggs']} | {s['sorts']} | {s['python']} |")
        details.append((name, s))
    print("\n## Scans (pushed filters / read schema)\n")
    for name, s in details:
        print(f"**{name}**")
        for sch in s["schemas"]:
            print(f"- reads `{sch}`")
        for p in s["pushed"]:
            print(f"- pushed `{p}`")
        print()
    spark.stop()


if __name__ == "__main__":
    main()
