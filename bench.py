"""Times the headline queries; prints one JSON line.

Tables from $BENCH_SF_DIR, on local[$BENCH_CPUS]; every query writes all its
rows to the noop sink once, after one query that warms up the session.  Each
figure also goes to stderr as it is taken.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from spanloom.plans.queries import QUERIES

HEADLINE = ("phrases", "phrases_events", "pack_lines", "range_join", "silences", "cues", "snap_asof", "label_thin", "top_layer", "rms_envelope", "frame_stats", "auto_grade", "render_plan", "best_take", "cache_pending", "event_sessions")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in (HEADLINE[0], *HEADLINE):  # the first one warms up
        begin = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
        print(name, seconds[name], file=sys.stderr)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("/", 1)[-1].removeprefix("sf")}))


if __name__ == "__main__":
    main()
