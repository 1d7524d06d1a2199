"""Times the catalog queries: one warm-up, then the median of three runs to the noop sink.

Writes one JSON line. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from reviewloom import session  # noqa: E402
from reviewloom.catalog.queries import QUERIES  # noqa: E402

RUNS = 3


def timed(spark: SparkSession, folder: str, name: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("reviewloom-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
    )
    spark = session.configure(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or list(QUERIES)
    seconds = {}
    for name in names:
        timed(spark, folder, name)
        runs = [timed(spark, folder, name) for _ in range(RUNS)]
        seconds[name] = round(statistics.median(runs), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "catalog_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
