"""

A plain form is the shortest DataFrame code that answers the same question: zones
joined to every trip, sums of doubles, ``max`` and ``first`` side by side. It
gives up what the library adds (sums that do not depend on the order of rows,
the longest trip's own duration, unique lookup keys, strict raw rows), so the
ratio is the price of that.

    python -m tools.plain_forms [--runs 5] [--json FILE]

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (8).
"""

from __future__ import annotations

import argparse
import json
import os
import statistics
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hackney.functions import haversine_km
from hackney.functions.timefn import elapsed_minutes
from hackney.plans import raw, registry
from hackney.schemas import REVENUE_COMPONENTS, TRIPS
from hackney.session import local_session
from hackney.sources import fixtures, rawtext

_COORDS = ["pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude"]


def _located(trips: DataFrame, names: list[str]) -> DataFrame:
    return trips.where(" AND ".join(f"{c} != 0" for c in names))


def q1(trips: DataFrame, zones: DataFrame) -> DataFrame:
    return (_located(trips, _COORDS[:2]).groupBy(F.hour("tpep_pickup_datetime").alias("hour"))
            .agg(F.avg("pickup_longitude").alias("lon"), F.avg("pickup_latitude").alias("lat")).orderBy("hour"))


def q2(trips: DataFrame, zones: DataFrame) -> DataFrame:
    legs = _located(trips, _COORDS).select("VendorID", haversine_km(*_COORDS).alias("km"),
                                           elapsed_minutes("tpep_pickup_datetime", "tpep_dropoff_datetime").alias("min"))
    return legs.groupBy("VendorID").agg(F.max("km").alias("km"), F.first("min").alias("min")).orderBy("VendorID")


def _zoned(trips: DataFrame, zones: DataFrame, key: str, column: str, name: str) -> DataFrame:
    side = zones.select(F.col("LocationID").alias(key), F.col(column).alias(name))
    return trips.join(side, key, "left")


def q3(trips: DataFrame, zones: DataFrame) -> DataFrame:
    both = _zoned(_zoned(trips, zones, "PULocationID", "Borough", "a"), zones, "DOLocationID", "Borough", "b")
    return both.where("a = b").groupBy("a").agg(F.count("*").alias("n")).orderBy(F.desc("n"))


def q4(trips: DataFrame, zones: DataFrame) -> DataFrame:
    night = trips.where((F.hour("tpep_pickup_datetime") >= 23) | (F.hour("tpep_pickup_datetime") < 7))
    return night.groupBy("VendorID").agg(F.count("*").alias("n")).orderBy(F.desc("n"))


def q5(trips: DataFrame, zones: DataFrame) -> DataFrame:
    both = _zoned(_zoned(trips, zones, "PULocationID", "Zone", "a"), zones, "DOLocationID", "Zone", "b")
    return (both.where("PULocationID != DOLocationID AND a IS NOT NULL AND b IS NOT NULL")
            .groupBy("a", "b").agg(F.count("*").alias("n")).orderBy(F.desc("n")).limit(20))


def q6(trips: DataFrame, zones: DataFrame) -> DataFrame:
    return (_zoned(trips, zones, "PULocationID", "Borough", "Borough").groupBy("Borough")
            .agg(*[F.sum(src).alias(dst) for src, dst in REVENUE_COMPONENTS]).orderBy(F.desc("grand_total")))


PLAIN = {"q1_hourly_mean_pickup": q1, "q2_longest_trip_per_vendor": q2, "q2_max_and_first": q2,
         "q3_same_borough_trips": q3, "q4_night_trips_per_vendor": q4, "q4_night_trips": q4, "q5_top_zone_pairs": q5,
         "q5_top_zone_pairs_by_id": q5, "q6_revenue_by_borough": q6, "q6_revenue_by_borough_unknown": q6}


def _plain_text_trips(spark: SparkSession, sf_dir: str, query: str) -> DataFrame:
    """Lines cut at commas and cast, as a text script does."""
    path = registry.raw_trips_text(spark, sf_dir)
    header = rawtext.header_line(spark, path)
    names = rawtext.header_names(header)
    lines = rawtext.read_lines(spark, path).where(F.col("value") != header).select(F.split("value", ",").alias("f"))
    columns = raw.RAW_VARIANTS[query][1]
    return lines.select(*[F.get("f", names.index(c)).try_cast(TRIPS[c].dataType).alias(c) for c in columns])


def plain(spark: SparkSession, sf_dir: str, query: str) -> DataFrame:
    base = query.removesuffix("_csv").removesuffix("_raw")
    if query.endswith("_csv"):
        return PLAIN[base](registry._csv_trips(spark, sf_dir), registry._csv_zones(spark, sf_dir))
    if query.endswith("_raw"):
        return PLAIN[base](_plain_text_trips(spark, sf_dir, query), registry._csv_zones(spark, sf_dir))
    return PLAIN[base](fixtures.trips(spark, sf_dir), fixtures.zones(spark, sf_dir))


def _seconds(make, runs: int) -> float:
    took = []
    for _ in range(runs + 1):
        start = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        took.append(time.perf_counter() - start)
    return statistics.median(took[1:])  # the first run warms up


def main() -> None:
    args = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    args.add_argument("--runs", type=int, default=5)
    args.add_argument("--json")
    args = args.parse_args()
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, app_name="hackney-plain-forms")
    names = [k for k in registry.QUERIES if k.removesuffix("_csv").removesuffix("_raw") in PLAIN]
    out = {}
    print("| query | plain form | library | ratio |\n| --- | --- | --- | --- |")
    for name in names:
        a = _seconds(lambda: plain(spark, sf_dir, name), args.runs)
        b = _seconds(lambda: registry.QUERIES[name](spark, sf_dir), args.runs)
        out[name] = {"plain": round(a, 3), "library": round(b, 3)}
        print(f"| `{name}` | {a:.2f} | {b:.2f} | {b / a:.1f} |", flush=True)
    if args.json:
        with open(args.json, "w") as f:
            json.dump(out, f)
    spark.stop()


if __name__ == "__main__":
    main()
