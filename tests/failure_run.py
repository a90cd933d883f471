"""Run queries with a task that fails on its first attempt (see test_failures.py).

Usage: python tests/failure_run.py <scratch dir>; prints OK or a diff.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from hackney.plans import queries as Q  # noqa: E402
from hackney.sources import files, fixtures  # noqa: E402

SF = "/root/testdata/sf0.01"


def fail_once(batches):
    """Pass rows through; the first attempt of partition 0 dies mid-stream."""
    ctx = TaskContext.get()
    for i, batch in enumerate(batches):
        if ctx.partitionId() == 0 and ctx.attemptNumber() == 0 and i == 1:
            raise RuntimeError("injected executor failure")
        yield batch


def main(scratch: str) -> int:
    spark = (SparkSession.builder.master("local[4,3]")      # 3 attempts per task
             .config("spark.ui.enabled", "false")
             .config("spark.checkpoint.dir", f"{scratch}/ckpt")
             .config("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
             .getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    files.write_parquet(fixtures.trips(spark, SF).repartition(4), f"{scratch}/trips")
    trips = files.read_parquet(spark, f"{scratch}/trips")
    zones = fixtures.zones(spark, SF)
    flaky = trips.mapInPandas(fail_once, trips.schema)
    checks = {
        "q6": (Q.revenue_by_borough(trips, zones), Q.revenue_by_borough(flaky, zones)),
        "q2": (Q.longest_trip_per_vendor(trips), Q.longest_trip_per_vendor(flaky)),
        "q5": (Q.top_zone_pairs(trips, zones), Q.top_zone_pairs(flaky, zones)),
    }
    bad = {k: (a.collect(), b.collect()) for k, (a, b) in checks.items()
           if a.collect() != b.collect()}
    print("OK" if not bad else f"DIFF {bad}")
    return 0 if not bad else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv[1]))
