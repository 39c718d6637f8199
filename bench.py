"""Time the named queries and print one JSON line.

``BENCH_SF_DIR`` names the folder of test tables, ``BENCH_CPUS`` the local cores, ``BENCH_RUNS`` the
runs per query, of which the median counts; replays of several deliveries run once. Streaming keeps its state in RocksDB, as the job does.
``BENCH_QUERIES`` limits the run to some names. Staged folders are removed at the end.
"""

from __future__ import annotations

import json
import os
import re
import shutil
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clickledger.queries import QUERIES  # noqa: E402
from clickledger.session import build_session  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
ONLY = os.environ.get("BENCH_QUERIES", "").split()


#: Replays of many micro-batches, long enough to be timed once.
REPLAYS = ("streaming_", "refresh_summaries_incremental", "category_performance_merged", "segment_performance_merged")


def timed(spark, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    staged = tempfile.mkdtemp(prefix="clickledger-bench-")
    spark = build_session(
        "clickledger-bench",
        f"local[{CPUS}]",
        streaming=True,
        spark__sql__shuffle__partitions=CPUS,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="12g",
        spark__checkpoint__dir=staged,
    )
    spark.sparkContext.setLogLevel("OFF")
    names = [n for n in QUERIES if not ONLY or n in ONLY]
    timed(spark, "first_click_attribution")
    runs = {name: 1 if name.startswith(REPLAYS) else RUNS for name in names}
    seconds = {name: statistics.median(timed(spark, name) for _ in range(runs[name])) for name in names}
    spark.stop()
    shutil.rmtree(staged)
    scale = re.search(r"sf([0-9.]+)", FOLDER)
    result = {
        "metric": "total seconds over all named queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": {name: round(value, 3) for name, value in seconds.items()},
        "sf": float(scale.group(1)) if scale else FOLDER,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
