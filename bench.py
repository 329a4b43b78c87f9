"""Seconds per headline query; prints one JSON line.

Each query runs once to warm up and then BENCH_RUNS times; the median counts, and the
spread is the distance of the slowest run from the fastest. Results are consumed in full
by the no-op sink, nothing is collected. State and staged tables go to BENCH_SHARED_DIR,
or a new folder below /tmp.
"""

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from reelmill.plans import catalog  # noqa: E402

HEADLINE = (
    "d9_newest",
    "d10_insert_new",
    "f1_build_request",
    "f4_collect_state",
    "f7_versioned_upsert",
    "f8_bulk_reprocess",
    "q1_needing_transcript",
    "q5_reprocess_candidates",
    "r12_completed_counts",
    "r13_summary",
    "r13_summary_after_pass",
    "r15_list_episodes",
    "r16_list_with_summaries",
    "t3_flatten_segments",
    "t4_flatten_rows",
    "t5_content_hash",
    "t6_classify_responses",
    "t10_apply_transitions",
    "u1_mark_fetched",
    "x2_incremental_fetch",
)


def session(cpus: str) -> SparkSession:
    shared = os.environ.get("BENCH_SHARED_DIR") or tempfile.mkdtemp(prefix="bench-", dir="/tmp")
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.checkpoint.dir", shared)
        .getOrCreate()
    )


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    registered = catalog.queries()
    names = sys.argv[1:] or HEADLINE
    seconds, spread = {}, {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times[1:]), 3)
        spread[name] = round(max(times[1:]) - min(times[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "spread": spread,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
