"""Times the registered queries and prints one JSON line.

Every query is written to Spark's ``noop`` sink, which computes all rows and columns
without moving them to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time

from millrace.plans import QUERIES
from millrace.session import local_session


def scale_of(sf_dir: str) -> float | str:
    name = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    try:
        return float(name)
    except ValueError:
        return name


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or list(QUERIES)
    spark = local_session(cpus)
    spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("event_type").count().collect()
    seconds = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name].plan(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": scale_of(sf_dir),
                "cores": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
