"""Command-line runner: one query over trip files, like the reference's scripts.

    spark-submit --py-files hackney.zip hackney/run.py q5_top_zone_pairs \\
        --trips hdfs:///data/trips/parquet --trips-format parquet \\
        --zones hdfs:///data/zones.csv

Prints the result (money/coordinates at fixed precision) and the elapsed
wall-clock time, or writes it as Parquet with ``--output``. The session comes
from ``getOrCreate`` so spark-submit's configuration applies.
"""

from __future__ import annotations

import argparse
import time

from pyspark.sql import DataFrame, SparkSession

from hackney.functions.display import report
from hackney.plans import queries as Q
from hackney.plans import raw
from hackney.plans.registry import TRIP_PLANS, ZONE_PLANS
from hackney.schemas import TRIPS, ZONES
from hackney.sources import files, layouts

QUERIES = sorted([*TRIP_PLANS, *ZONE_PLANS])


def read_trips(spark: SparkSession, path: str, fmt: str, query: str, strict: bool = False,
               mixed: bool = False, quoted: bool = False) -> DataFrame:
    if fmt == "parquet":
        return (layouts if mixed else files).read_parquet(spark, path, schema=TRIPS)
    if fmt == "csv":
        return (layouts if mixed else files).read_csv(spark, path, schema=TRIPS)
    if fmt == "text":
        return raw.read_trips(spark, path, query, strict, mixed, quoted)
    raise ValueError(f"unknown trips format {fmt!r}")


def read_zones(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    if fmt == "parquet":
        return files.read_parquet(spark, path, schema=ZONES)
    return files.read_csv(spark, path, schema=ZONES)


def build(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    trips = read_trips(spark, args.trips, args.trips_format, args.query, args.strict, args.mixed_layouts, args.quoted)
    if args.query == "q1_hourly_mean_pickup":
        return Q.hourly_mean_pickup(trips, keep_null_hour=args.keep_null_hour)
    if args.query == "q2_longest_trip_per_vendor":
        return Q.longest_trip_per_vendor(trips, ties=args.ties)
    if args.query in TRIP_PLANS:
        return TRIP_PLANS[args.query](trips)
    if not args.zones:
        raise SystemExit(f"{args.query} needs --zones")
    return ZONE_PLANS[args.query](trips, read_zones(spark, args.zones, args.zones_format))


def convert(spark: SparkSession, pairs: list[str], infer_schema: bool = False) -> list[str]:
    """CSV to Parquet for each SOURCE=TARGET; trip and zone files get their declared types."""
    conversions = [tuple(pair.split("=", 1)) for pair in pairs]
    if any(len(c) != 2 for c in conversions):
        raise SystemExit("convert takes SOURCE=TARGET pairs")
    schemas = {}
    for source, target in conversions if not infer_schema else []:
        header = {name.lower() for name in files.csv_header(spark, source)}
        for schema in (TRIPS, ZONES):
            if schema.fieldNames()[0].lower() in header:
                schemas[target] = schema
    return files.csv_to_parquet(spark, conversions, schemas=schemas, infer_schema=infer_schema)


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="hackney.run", description=__doc__.split("\n")[0])
    p.add_argument("query", choices=[*QUERIES, "convert"])
    p.add_argument("pairs", nargs="*", help="convert: SOURCE=TARGET folders of CSV and Parquet")
    p.add_argument("--infer-schema", action="store_true", help="convert: infer types")
    p.add_argument("--trips", help="trip files (any Hadoop-FS URI)")
    p.add_argument("--trips-format", choices=["parquet", "csv", "text"], default="parquet")
    p.add_argument("--zones", help="zone lookup files")
    p.add_argument("--zones-format", choices=["parquet", "csv"], default="csv")
    p.add_argument("--strict", action="store_true", help="text: drop rows with any malformed needed field")
    p.add_argument("--quoted", action="store_true", help="text: fields may stand in double quotes")
    p.add_argument("--mixed-layouts", action="store_true", help="the trip files differ in columns or their order")
    p.add_argument("--keep-null-hour", action="store_true", help="Q1: keep trips without a time as a group")
    p.add_argument("--ties", choices=["longer", "any"], default="longer", help="Q2: which of equally long trips")
    p.add_argument("--output", help="write the result here as Parquet instead of printing")
    p.add_argument("--show", type=int, default=50, help="rows to print")
    p.add_argument("--explain", action="store_true",
                   help="print the formatted physical plan before running")
    args = p.parse_args(argv)
    if args.query != "convert" and not args.trips:
        p.error(f"{args.query} needs --trips")
    return args


def main(argv: list[str] | None = None) -> DataFrame | None:
    args = parse_args(argv)
    spark = SparkSession.builder.appName(f"hackney-{args.query}").getOrCreate()
    start = time.perf_counter()
    if args.query == "convert":
        for target in convert(spark, args.pairs, args.infer_schema):
            print(target)
        print(f"convert: {time.perf_counter() - start:.2f} s")
        return None
    result = build(spark, args)
    if args.explain:
        result.explain("formatted")
    if args.output:
        files.write_parquet(result, args.output)
    else:
        shown = report(result, decimals=6 if args.query.startswith("q1") else 2).take(args.show + 1)
        spark.createDataFrame(shown[:args.show], result.schema).show(args.show, truncate=False)
        if len(shown) > args.show:
            print(f"only the first {args.show} rows; --show or --output gives more")
    print(f"{args.query}: {time.perf_counter() - start:.2f} s")
    return result


if __name__ == "__main__":
    main()
