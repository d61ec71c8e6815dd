"""Write PLANS.md: final adaptive plans of selected queries after execution.

usage: python tools/plan_report.py [sf_dir]
Only the operator lines that decide cost are kept (exchanges, joins,
aggregates, windows, limits, generators, scans with their pushdown).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from reelstats.plans.catalog import QUERIES  # noqa: E402
from reelstats.session import build_session  # noqa: E402

SELECTED = ["popular_items_by_month", "genre_top10", "dense_code", "item_similarity",
            "item_cf_top30", "item_cf_unseen", "eval_macro_at_k", "eval_micro_at_k",
            "rating_histogram", "top10_by_raters", "als_top20"]
KEEP = re.compile(r"(QueryStage|Reused|Exchange|Join|HashAggregate|ObjectHashAggregate|SortAggregate|Window|"
                  r"WindowGroupLimit|TakeOrderedAndProject|Generate|Scan parquet|FileScan|"
                  r"AQEShuffleRead|BroadcastExchange|Expand|Union|Limit|InMemoryTableScan)")


def condense(plan: str) -> list[str]:
    out = []
    plan = plan.split("== Initial Plan ==")[0]   # keep the final adaptive plan only
    for line in plan.splitlines():
        if KEEP.search(line):
            line = re.sub(r"#\d+L?", "", line)
            line = re.sub(r", \[plan_id=\d+\]", "", line)
            line = re.sub(r"(PushedFilters: \[[^\]]*\]).*", r"\1", line)
            out.append(line[:190])
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=16, conf={"spark.driver.memory": "16g"})
    parts = ["# Final plans (after AQE) at " + os.path.basename(sf_dir.rstrip("/")),
             "", "Generated by `tools/plan_report.py` on local[8]; operator lines only.",
             "`ReusedExchange` marks a shuffle computed once and read twice; joins show the",
             "strategy AQE chose from measured sizes (broadcast only below the threshold).", ""]
    for name in SELECTED:
        df = QUERIES[name](spark, sf_dir)
        qe = df._jdf.queryExecution()
        qe.toRdd().count()            # run this DataFrame's own plan so AQE finalises it
        plan = qe.executedPlan().toString()
        parts += [f"## {name}", "", "```", *condense(plan), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main()
