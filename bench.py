"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries",
"sf", ...}. Each query is executed in full with the no-op sink (all rows
produced, nothing collected); a warm-up pass on the smallest data set is
excluded from the timings.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "decode_messages", "feed_outcomes", "count_by_type", "type_breakdown", "recent_activity",
    "median_split", "time_gaps", "gap_summary", "latest_ticker", "latest_depth", "stats_15s",
    "table_scan_ordered", "parse_depth_levels", "integrity_audit", "reconcile_report",
    "export_roundtrip", "hourly_export_cycle", "stream_ingest",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from feedlake.session import get_session
    from feedlake.plans import register
    spark = get_session(f"local[{cpus}]", app="feedlake-bench", shuffle_partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    qs = register.queries()
    keys = [k for k in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if k in qs]

    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm):
        for k in ("decode_messages", "count_by_type"):
            qs[k](spark, warm).write.format("noop").mode("overwrite").save()

    frames = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    timings: dict[str, float] = {}
    # The message table that the reports read is built once; a line of its own, so that no report pays for it.
    from feedlake.plans.queries import msgs
    t0 = time.perf_counter()
    msgs(spark, sf_dir)
    timings["build_silver"] = round(time.perf_counter() - t0, 3)
    for k in keys:
        t0 = time.perf_counter()
        qs[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[k] = round(time.perf_counter() - t0, 3)
    total = round(sum(timings.values()), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_queries_total",
        "value": total,
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "frames": frames,
        "decode_frames_per_sec": round(frames / timings["decode_messages"], 1) if timings.get("decode_messages") else None,
    }
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
