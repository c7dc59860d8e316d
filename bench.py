"""Times every registered query on the tables at $BENCH_SF_DIR and prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

from tallyline.plans import catalog
from tallyline.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
WARM_UP = ["metered_chat", "stream_usage_counters"]


def seconds(spark, query) -> float:
    begin = time.perf_counter()
    query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main(names: list[str]) -> None:
    spark = build_session(
        "tallyline-bench",
        f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__ui__enabled="false",
        spark__driver__memory="16g",
        spark__log__level="ERROR",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="tallyline-bench-"),
    )
    for name in WARM_UP:
        seconds(spark, catalog.QUERIES[name])
    times = {
        name: round(statistics.median(seconds(spark, query) for _ in range(RUNS)), 3)
        for name, query in catalog.QUERIES.items()
        if not names or name in names
    }
    scale = re.search(r"sf([0-9.]+)", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "total median time of all registered queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main(sys.argv[1:])
