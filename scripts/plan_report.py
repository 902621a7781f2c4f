"""Write PLANS.md: physical plans of the headline queries.

    python scripts/plan_report.py [sf_dir]

For each query: the operator tree of ``explain("formatted")`` and, for every
scan, what reached it (partition filters, pushed filters, read schema).
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402

EXTRA = ["unique_combination_audit", "not_in_exclude", "edge_join", "append_load"]


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarise(text: str) -> str:
    tree, scans = [], []
    lines = text.splitlines()
    in_tree = False
    for line in lines:
        if line.startswith("== Physical Plan =="):
            in_tree = True
            continue
        if in_tree:
            if not line.strip():
                in_tree = False
                continue
            tree.append(line)
    current = None
    for line in lines:
        m = re.match(r"^\((\d+)\) Scan (\w+)", line)
        if m:
            current = [f"scan ({m.group(1)})"]
            scans.append(current)
            continue
        if current is not None:
            if line.startswith(("PartitionFilters", "PushedFilters", "ReadSchema")):
                current.append("  " + line[:400])
            elif not line.strip():
                current = None
    return "\n".join(tree) + "\n\n" + "\n".join("\n".join(s) for s in scans)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from hopgraph.queries import REGISTRY
    from hopgraph.session import build_session
    spark = build_session("local[8]")
    out = ["# PLANS", "",
           f"Physical plans (`explain(\"formatted\")`, before AQE re-planning) at `{sf_dir}`,",
           "generated by `scripts/plan_report.py`. Exchange = shuffle; BroadcastExchange = broadcast.",
           "Stages marked `*` run in whole-stage codegen (see the formatted plan ids).", ""]
    for name in HEADLINE + EXTRA:
        text = formatted(REGISTRY[name].spark(spark, sf_dir))
        shuffles = len(re.findall(r"\bExchange \(\d+\)", text)) - len(re.findall(r"BroadcastExchange \(\d+\)", text))
        broadcasts = len(re.findall(r"BroadcastExchange \(\d+\)", text))
        out += [f"## {name}", "", f"shuffles: {shuffles}, broadcasts: {broadcasts}", "", "```",
                summarise(text), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
