"""Time the registered queries and print one JSON line.

Each query runs once after a short warm-up of the session and its result is consumed in
full by a sink that discards it. Set BENCH_QUERIES to a comma-separated list to time some.
"""

from __future__ import annotations

import json
import os
import sys
import time

from meterlake.plans.registry import queries
from meterlake.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def consume(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(
        "meterlake-bench",
        f"local[{CPUS}]",
        **{
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()
    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else list(registered)

    consume(registered["coverage"](spark, SF_DIR))
    timings = {}
    for name in names:
        started = time.perf_counter()
        consume(registered[name](spark, SF_DIR))
        timings[name] = round(time.perf_counter() - started, 3)
        print(f"{name}: {timings[name]}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
