"""Hot-user experiment for the co-rating step (not a registered query).

usage: python tools/skew_experiment.py SF_DIR MODULO EVENT_LOG_DIR
Moves the ratings of every MODULO-th item to one user (derived from the given
tables), runs the co-rating sums unsalted and salted, and prints wall times and
the longest task of each run (from Spark's event log in EVENT_LOG_DIR).
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import time

import zstandard
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from reelstats.operators import itemcf  # noqa: E402
from reelstats.plans.catalog import Ctx  # noqa: E402
from reelstats.session import build_session  # noqa: E402


def main() -> None:
    sf_dir, modulo, logdir = sys.argv[1], int(sys.argv[2]), sys.argv[3]
    spark = build_session("local[8]", shuffle_partitions=16,
                          conf={"spark.eventLog.enabled": "true", "spark.eventLog.dir": logdir})
    train = Ctx(spark, sf_dir).train
    hot = train.withColumn("user_id", F.when(F.col("movie_id") % modulo == 0, F.lit(0))
                           .otherwise(F.col("user_id"))).persist()
    hot.count()
    wall = []
    for label, chunk in [("unsalted", 10**9), ("salted", itemcf.DEFAULT_CHUNK)] * 2:
        spark.sparkContext.setJobGroup(label, label)
        t0 = time.perf_counter()
        itemcf.co_rating_sums(hot, chunk=chunk).write.format("noop").mode("overwrite").save()
        wall.append((label, round(time.perf_counter() - t0, 2)))
    spark.stop()
    groups, longest = {}, {}
    for f in glob.glob(os.path.join(logdir, "*", "events*")):
        raw = open(f, "rb").read()
        text = (zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read().decode()
                if f.endswith(".zstd") else raw.decode())
        for line in text.splitlines():
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                for sid in e["Stage IDs"]:
                    groups[sid] = (e.get("Properties") or {}).get("spark.jobGroup.id")
            elif e["Event"] == "SparkListenerTaskEnd":
                g, ti = groups.get(e["Stage ID"]), e["Task Info"]
                if g:
                    longest[g] = max(longest.get(g, 0), (ti["Finish Time"] - ti["Launch Time"]) / 1000)
    print(json.dumps({"wall_sec": wall, "longest_task_sec": longest}))


if __name__ == "__main__":
    main()
