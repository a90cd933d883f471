"""Raw-text twins of the queries: the reference's text-reading scripts.

Each twin parses only the fields its base query needs (so a row cut short
after them still counts) and runs the base query's plan on the typed rows.
Keys map to (base query, parsed columns).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hackney.schemas import REVENUE_COMPONENTS, TRIPS
from hackney.sources import layouts, rawtext

#: A row may end before this column: it is the last of the files that have it.
OPTIONAL = ("airport_fee",)

_COORDS = ["pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude"]

RAW_VARIANTS: dict[str, tuple[str, list[str]]] = {
    # Q1 drops trips without an hour, as the text script does.
    "q1_hourly_mean_pickup_raw":
        ("q1_hourly_mean_pickup", ["tpep_pickup_datetime", "pickup_longitude", "pickup_latitude"]),
    "q2_longest_trip_per_vendor_raw":
        ("q2_longest_trip_per_vendor",
         ["VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", *_COORDS]),
    "q3_same_borough_trips_raw": ("q3_same_borough_trips", ["PULocationID", "DOLocationID"]),
    "q4_night_trips_raw": ("q4_night_trips_per_vendor", ["VendorID", "tpep_pickup_datetime"]),
    "q5_top_zone_pairs_by_id_raw": ("q5_top_zone_pairs_by_id", ["PULocationID", "DOLocationID"]),
    # Q6 with whole-row validity: a malformed field drops the row (RDD variant).
    "q6_revenue_by_borough_raw":
        ("q6_revenue_by_borough_unknown",
         ["PULocationID", *[src for src, _ in REVENUE_COMPONENTS]]),
}

_COLUMNS = {**{base: columns for base, columns in RAW_VARIANTS.values()},
            "q2_max_and_first": RAW_VARIANTS["q2_longest_trip_per_vendor_raw"][1],
            "q5_top_zone_pairs": RAW_VARIANTS["q5_top_zone_pairs_by_id_raw"][1],
            "q6_revenue_by_borough": RAW_VARIANTS["q6_revenue_by_borough_raw"][1]}
#: Queries whose text script drops a row with a bad field. All fields but the
#: fee are required by the query itself, so only the fee needs the test.
_STRICT = {"q6_revenue_by_borough_unknown": OPTIONAL}


def read_trips(spark: SparkSession, path: str, query: str, strict: bool = False, mixed: bool = False,
               quoted: bool = False) -> DataFrame:
    """Trips from raw text with the fields that ``query`` needs.

    ``strict`` drops rows in which any of these fields is malformed; with
    ``mixed`` every file's own header counts; ``quoted`` reads quoted fields.
    """
    columns = _COLUMNS[query]
    options = dict(columns=columns, drop_malformed=strict or _STRICT.get(query, False), quoted=quoted,
                   optional=[c for c in OPTIONAL if c in columns])
    if mixed:
        return layouts.ingest(spark, path, TRIPS, **options)
    return rawtext.ingest(spark, path, TRIPS, absent_as_null=True, **options)
