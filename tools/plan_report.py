"""Write PLANS.md: physical-plan evidence for the headline queries.

For each query: the plan tree (before execution, as AQE starts from it),
the number of shuffle exchanges and broadcasts, the pushed filters and
the columns each scan reads.  Usage: python tools/plan_report.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from bench import HEADLINE
    from shelfwise import catalog
    from shelfwise.plans import evidence as P
    from shelfwise.session import local_session

    spark = local_session(8)
    qs = catalog.queries()
    out = ["# PLANS", "", f"Physical plans of the headline queries over `{sf_dir}` (generated by `tools/plan_report.py`).",
           "Plans are shown before execution; AQE may still turn a sort-merge join into a broadcast at run time.",
           "", "| query | shuffles | broadcasts | scans: columns read | pushed filters |", "|---|---|---|---|---|"]
    trees = []
    for k in HEADLINE:
        df = qs[k](spark, sf_dir)
        text = P.plan_text(df)
        facts = P.parse_plan(text)
        shuffles = sum(1 for _i, n, f, _v in facts if f is None and n.startswith("Exchange"))
        bcasts = sum(1 for _i, n, f, _v in facts if f is None and n.startswith("BroadcastExchange"))
        cols = "; ".join(",".join(c) for c in P.scanned_columns(df))
        pushed = "; ".join(v for _i, _n, f, v in facts if f == "PushedFilters" and v != "[]")
        out.append(f"| `{k}` | {shuffles} | {bcasts} | {cols} | {pushed[:300]} |")
        trees.append(f"### {k}\n\n```\n{text.split(chr(10) + chr(10))[0]}\n```\n")
    out += ["", "## Plan trees", ""] + trees
    open(os.path.join(ROOT, "PLANS.md"), "w").write("\n".join(out) + "\n")
    spark.stop()
    print(f"wrote PLANS.md ({len(HEADLINE)} queries)")


if __name__ == "__main__":
    main()
