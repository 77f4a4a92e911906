"""Time the registered queries; prints one JSON line.

BENCH_SF_DIR   folder with the tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  names separated by commas (default: all)

Each query runs once cold and then once warm in the same session; ``queries``
holds the warm seconds and ``cold`` the first ones. A result is consumed whole
by Spark's ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

from salesmart.registry import QUERIES
from salesmart.session import build_session


def seconds(spark, name: str, folder: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="12g",
        spark__sql__shuffle__partitions=cpus,
    )
    spark.sparkContext.setLogLevel("ERROR")
    cold, warm = {}, {}
    for name in names:
        cold[name] = seconds(spark, name, folder)
        warm[name] = seconds(spark, name, folder)
        print(f"{name:22} {cold[name]:8.2f} {warm[name]:8.2f}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "all registered queries, warm",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
