"""Write docs/PLANS.md: the physical plans of the key operators, with notes.

Usage: python tools/plans_report.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HERE)

from reviewlake.plans.catalog import Q  # noqa: E402
from reviewlake.session import local_session  # noqa: E402

NOTES = {
    "clean_reviews": "One exchange, on the review id. WindowGroupLimit (Partial) sits *below* it: each map task "
                     "forwards one row per id, so a hot duplicated id cannot flood a reducer.",
    "incremental_ingest": "Two exchanges, each pre-limited: per (batch, id), then per id for first-writer-wins.",
    "insert_new_reviews": "The anti-join reuses the review-id partitioning of both dedupe windows (no extra exchange).",
    "insert_new_reviews_bucketed": "Stored side read in place (Bucketed: true); only the incoming side is exchanged. "
                                   "(Shown with auto-broadcast off, as for a large table.)",
    "constraint_rejects": "Apps broadcast behind a row check; rows meet their id's facts on (id, first arrival).",
    "accepted_reviews": "Foreign key as a broadcast left-semi join against the (checked) app keys.",
    "reviews_table_read_pruned": "Stored layout: PartitionFilters on app_id, PushedFilters on reviewed_at.",
    "reviews_latest": "Top-k as TakeOrderedAndProject, no global sort.",
    "statistics": "One pass: Expand (cube) + partial aggregation for per-app, per-score and total counts.",
    "numeric_summary_distributed": "The moments in one aggregation; the exact quartiles arrive as literals, computed "
                                   "beforehand by operators/quantiles.py ((value, count) pre-aggregation, range "
                                   "partitioning, cumulative counts per partition, broadcast offsets).",
}


def clean_plan(text: str) -> str:
    text = re.sub(r"#\d+L?", "", text)
    text = "".join(ch if ch.isprintable() or ch == "\n" else f"\\u{ord(ch):04x}" for ch in text)
    out = []
    for line in text.splitlines():
        # operator lines only (a literal newline inside an expression breaks a line)
        if not re.match(r"^(AdaptiveSparkPlan|[ :]*(\+-|:-)|[ :]*[A-Z][A-Za-z]+ )", line):
            continue
        if "FileScan" in line:
            head = line.split(" Batched:")[0]
            keep = [m.group(0)[:300] for key in ("Bucketed", "PartitionFilters", "PushedFilters", "ReadSchema")
                    for m in [re.search(key + r": (\[[^\]]*\]|[^,]*)", line)] if m]
            out.append(head[:110] + (" ... " if len(head) > 110 else " ") + ", ".join(keep))
            continue
        out.append(line if len(line) <= 150 else line[:147] + "...")
    return "\n".join(out)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # full filter lists in scan nodes
    parts = ["# Physical plans of the key operators\n",
             f"Generated by `tools/plans_report.py` on `{sf}` (`local[*]`, AQE on; plans before AQE re-planning).\n"]
    for name, note in NOTES.items():
        if name == "insert_new_reviews_bucketed":
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
            spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        df = Q[name](spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        if name == "insert_new_reviews_bucketed":
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
            spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        parts.append(f"## `{name}`\n\n{note}\n\n```\n{clean_plan(plan)}\n```\n")
    with open(os.path.join(HERE, "docs", "PLANS.md"), "w") as fh:
        fh.write("\n".join(parts))
    print("wrote docs/PLANS.md")


if __name__ == "__main__":
    main()
