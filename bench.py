"""Benchmark the headline queries.

Runs each query of HEADLINE on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
with ``local[$BENCH_CPUS]`` and prints one JSON line.  Every query is run to
completion through the ``noop`` sink (full execution, nothing collected).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from reelstats.plans.catalog import QUERIES  # noqa: E402
from reelstats.session import build_session  # noqa: E402

HEADLINE = [
    "profile_duplicates", "clean_rating", "attr_repair", "popular_items",
    "popular_items_by_month", "avg_rating", "genre_top10", "dense_code", "split_hash",
    "item_similarity", "item_cf_top30", "item_cf_unseen", "decode_recs", "eval_macro_at_k",
    "eval_micro_at_k", "rmse_item_mean", "dashboard_totals", "rating_histogram",
    "poster_recent50", "rmse_als", "als_top20",
]


# Small results whose values are reported next to the timings (model quality,
QUALITY = {"rmse_item_mean", "rmse_als", "eval_macro_at_k", "eval_micro_at_k"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", app="reelstats-bench",
                          shuffle_partitions=max(8, 2 * cpus),
                          conf={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "16g")})
    # warm-up: JVM start, class loading and the first parquet footers
    QUERIES["popular_items"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times, quality = {}, {}
    for name in names:
        t0 = time.perf_counter()
        df = QUERIES[name](spark, sf_dir)
        if name in QUALITY:
            quality[name] = [r.asDict() for r in df.collect()]
        else:
            df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
        "quality": quality,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
