"""Seconds, rows and shuffle bytes per headline query, as a Markdown table.

    python bench_detail.py /root/testdata/sf0.01 /root/testdata/sf0.1
"""

import os
import statistics
import sys
import time

from bench import HEADLINE, session
from reelmill.plans import catalog


def stage_totals(spark) -> tuple[int, int]:
    """(records read, shuffle bytes written) of all stages so far."""
    jvm = spark._jvm
    none = spark.sparkContext._gateway.new_array(jvm.double, 0)
    stages = spark._jsc.sc().statusStore().stageList(
        None, False, False, none, jvm.java.util.ArrayList()
    )
    found = [stages.apply(i) for i in range(stages.size())]
    return sum(s.inputRecords() for s in found), sum(s.shuffleWriteBytes() for s in found)


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    registered = catalog.queries()
    print("| operator | sf | seconds | rows in / out | shuffle bytes | cores |")
    print("|---|---|---|---|---|---|")
    for sf_dir in sys.argv[1:]:
        scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
        for name in HEADLINE:
            rows_out = registered[name](spark, sf_dir).count()
            times = []
            before = stage_totals(spark)
            for i in range(2):
                started = time.perf_counter()
                registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                times.append(time.perf_counter() - started)
                if i == 0:
                    after = stage_totals(spark)
            read, shuffled = (b - a for a, b in zip(before, after))
            print(
                f"| {name} | {scale} | {statistics.median(times):.2f} | {read:,} / {rows_out:,} "
                f"| {shuffled:,} | {cpus} |",
                flush=True,
            )
    spark.stop()


if __name__ == "__main__":
    main()
