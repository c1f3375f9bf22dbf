"""Times the named queries and prints one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the tables and the cores,
``BENCH_QUERIES`` a comma-separated choice of names. Every query runs to its
last row: once to warm up, then three times, of which the median counts. The
streamed refresh is timed as ``refresh_cycle``, once, from empty.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from dealscope.plans import views  # noqa: E402
from dealscope.plans.catalog import QUERIES  # noqa: E402
from dealscope.session import build_session, shared_dir  # noqa: E402
from dealscope.streaming import feeds, refresh  # noqa: E402

RUNS = 3
# Stateful or writing queries, too slow to repeat; timed through refresh_cycle
# or once.
ONCE = {"raw_incremental_latest", "funnel_daily_stream", "funnel_daily_late"}


def timed(job) -> float:
    start = time.perf_counter()
    job()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else [n for n in QUERIES if not n.startswith("refreshed_")] + ["refresh_cycle"]
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.checkpoint.dir": f"file://{tempfile.mkdtemp(prefix='dealscope-bench-')}",
    })
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str):
        return lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    def cycle() -> None:
        root = shared_dir(spark, "bench-refresh")
        refresh.refresh(spark, views.feeds(spark, sf_dir), root, f"{root}/checkpoint", views.SETTINGS,
                        feeds.AVAILABLE_NOW)

    seconds = {}
    for name in names:
        if name == "refresh_cycle":
            seconds[name] = timed(cycle)
        elif name in ONCE:
            seconds[name] = timed(run(name))
        else:
            run(name)()
            seconds[name] = statistics.median(timed(run(name)) for _ in range(RUNS))
        seconds[name] = round(seconds[name], 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
