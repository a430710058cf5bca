"""Time the registered queries: one JSON line.

Reads the tables at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS]. Each query runs once to warm up and then $BENCH_RUNS times
(default 3) into a sink that drops the rows; the median counts. A query that
took over 10 seconds to warm up, such as a stream of several runs, runs once
more only. Names on the command line limit the run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from registry.queries import REGISTERED  # noqa: E402
from shiftlab.session import build_session  # noqa: E402


#: Seconds of warm-up beyond which one more run has to do.
LONG = 10


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session("bench", master=f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or list(REGISTERED)
    timings = {}
    for name in names:
        seconds = []
        while len(seconds) <= (runs if not seconds or seconds[0] < LONG else 1):
            begin = time.perf_counter()
            REGISTERED[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - begin)
        timings[name] = round(statistics.median(seconds[1:]), 3)
    spark.stop()
    print(json.dumps({
        "metric": "sum of median query times", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus), "runs": runs}))


if __name__ == "__main__":
    main()
