"""The trip queries, as pure functions of the ``trips`` and ``zones`` DataFrames.

Each returns a lazily planned DataFrame with a total order; the caller runs
the action. Sources are irrelevant here: the same function runs over the
Parquet tables, a typed CSV read, or rows parsed from raw text.

Plan shape, chosen for a fact table of trillions of rows and a dimension of a
few hundred, and the same at every size of either:

* every aggregate has a partial (map-side) phase, so the shuffles carry one
  row per group per task, never raw trips, and a hot key (a third of all
  trips in one zone or vendor) is combined before it reaches any one task;
* trips are counted or summed per zone id (pair) first, the finished sums meet
  the zone table, and are summed again per borough or zone name: a lookup joins
  a row per id, whether the optimiser broadcasts the zones or not;
* money and means are summed exactly (``hackney.functions.numeric``), so
  results do not depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hackney.functions.geo import haversine_km
from hackney.functions.numeric import (DEGREE_DECIMALS, MONEY_DECIMALS, mean_of, part_names,
                                       round_to, total_of, with_parts)
from hackney.functions.timefn import elapsed_seconds, is_night, pickup_hour
from hackney.operators.argmax import arg_max_packed, first_packed
from hackney.operators.filters import DROPOFF_COORDS, PICKUP_COORDS, nonzero_coordinates
from hackney.operators.lookup import count_per, lookup_join, sum_again
from hackney.operators.topk import sort_small, sort_total, top_k
from hackney.schemas import REVENUE_COMPONENTS

PU, DO = "PULocationID", "DOLocationID"
ZONE_KEY = "LocationID"

# Fixed values (must equal the reference's): the label of zones missing from
# the lookup, and the number of zone pairs reported.
UNKNOWN = "Unknown"
TOP_PAIRS = 20


# -- Q1 ---------------------------------------------------------------------

def hourly_mean_pickup(trips: DataFrame, keep_null_hour: bool = False) -> DataFrame:
    """Mean pick-up longitude/latitude per hour of day, zero fixes excluded.

    Columns: hour, avg_longitude, avg_latitude (6 decimals). A trip with no
    pick-up time has no hour; it is dropped unless ``keep_null_hour``, which
    keeps it as a NULL-hour group (the DataFrame variant's behaviour).
    """
    rows = (trips.where(nonzero_coordinates(*PICKUP_COORDS))
            .select(pickup_hour().alias("hour"), *PICKUP_COORDS))
    if not keep_null_hour:
        rows = rows.where(F.col("hour").isNotNull())
    sums = with_parts(rows, ["hour"], {"lon": "pickup_longitude", "lat": "pickup_latitude"},
                      DEGREE_DECIMALS, count=True)
    out = sums.select("hour", mean_of("lon").alias("avg_longitude"), mean_of("lat").alias("avg_latitude"))
    return sort_small(out, "hour")  # <= 25 rows: 24 hours (+ NULL)


# -- Q2 ---------------------------------------------------------------------

def _trip_legs(trips: DataFrame) -> DataFrame:
    """Trips with both fixes known: vendor, distance (km), duration (whole seconds), pick-up time."""
    return (trips.where(nonzero_coordinates(*PICKUP_COORDS, *DROPOFF_COORDS))
            .select("VendorID", "tpep_pickup_datetime",
                    haversine_km(*PICKUP_COORDS, *DROPOFF_COORDS).alias("distance"),
                    elapsed_seconds("tpep_pickup_datetime",
                                    "tpep_dropoff_datetime").alias("seconds")))


def _minutes(name: str) -> Column:
    return (F.col("seconds") / F.lit(60.0)).alias(name)


def longest_trip_per_vendor(trips: DataFrame, ties: str = "longer") -> DataFrame:
    """The longest trip per vendor and that same trip's duration (arg-max).

    ``ties="longer"`` (default): equal distances are broken by the longer
    duration, ``ties="any"`` gives any of the tied trips (the RDD variant's
    semantics) via ``max_by``. Both are hash aggregates over one scan.
    Columns: VendorID, max_distance_km (6 decimals), trip_duration_min.
    """
    legs = _trip_legs(trips)
    if ties == "longer":
        best = arg_max_packed(legs, ["VendorID"], "distance", "seconds")
    elif ties == "any":
        best = legs.groupBy("VendorID").agg(
            F.max("distance").alias("distance"), F.max_by("seconds", "distance").alias("seconds"))
    else:
        raise ValueError(f"ties must be 'longer' or 'any', not {ties!r}")
    out = best.select("VendorID", round_to("distance", 6).alias("max_distance_km"),
                      _minutes("trip_duration_min"))
    return sort_total(out, "VendorID")


def max_and_first_per_vendor(trips: DataFrame) -> DataFrame:
    """Max distance per vendor next to the duration of the vendor's *first* trip.

    The two values come from different trips (the DataFrame variant's
    ``max`` + ``first``); "first" is made deterministic as the earliest
    pick-up, then the shortest duration. Columns: VendorID, max_distance_km,
    first_duration_min.
    """
    best = _trip_legs(trips).groupBy("VendorID").agg(
        round_to(F.max("distance"), 6).alias("max_distance_km"),
        first_packed("seconds", "tpep_pickup_datetime").alias("seconds"))
    return sort_total(best.select("VendorID", "max_distance_km", _minutes("first_duration_min")), "VendorID")


# -- Q3 ---------------------------------------------------------------------

def _pair_filter(distinct_ids: bool):
    if distinct_ids:
        return F.col(PU) != F.col(DO)   # NULL-rejecting as well
    return F.col(PU).isNotNull() & F.col(DO).isNotNull()


def _pair_counts(trips: DataFrame, name: str, distinct_ids: bool = False) -> DataFrame:
    """Trip counts per (pick-up id, drop-off id), NULL ids dropped."""
    return count_per(trips.where(_pair_filter(distinct_ids)), [PU, DO], name)


def _named_pairs(trips: DataFrame, zones: DataFrame, attr: str, names: tuple[str, str],
                 measure: str, distinct_ids: bool) -> DataFrame:
    """Trip counts per id pair with the zone attribute ``attr`` of both ends; unknown ids dropped."""
    counts = _pair_counts(trips, measure, distinct_ids)
    named = lookup_join(counts, zones, PU, ZONE_KEY, {attr: names[0]}, how="inner")
    return lookup_join(named, zones, DO, ZONE_KEY, {attr: names[1]}, how="inner")


def same_borough_trips(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips that start and end in the same borough, per borough.

    Trips whose zone is unknown at either end are not counted. Columns:
    PickupBorough, TotalTrips.
    """
    named = _named_pairs(trips, zones, "Borough", ("PickupBorough", "DropoffBorough"), "TotalTrips",
                         distinct_ids=False)
    same = named.where(F.col("PickupBorough") == F.col("DropoffBorough"))
    return sort_total(sum_again(same, ["PickupBorough"], ["TotalTrips"]), "-TotalTrips", "PickupBorough")


# -- Q4 ---------------------------------------------------------------------

def night_trips_per_vendor(trips: DataFrame) -> DataFrame:
    """Trips picked up 23:00-06:59 per vendor. Columns: VendorID, NightTripsCount.

    A trip with no (or an unparseable) pick-up time is not a night trip.
    """
    return sort_total(night_trip_counts(trips), "-NightTripsCount", "VendorID")


def night_trip_counts(trips: DataFrame) -> DataFrame:
    """Unordered Q4 aggregate (also valid on a streaming ``trips``)."""
    return (trips.where(is_night("tpep_pickup_datetime"))
            .groupBy("VendorID").agg(F.count(F.lit(1)).alias("NightTripsCount")))


# -- Q5 ---------------------------------------------------------------------

def top_zone_pairs(trips: DataFrame, zones: DataFrame, k: int = TOP_PAIRS) -> DataFrame:
    """The ``k`` busiest (pick-up zone, drop-off zone) name pairs, ids differing.

    Trips are counted per id pair, named, and summed per zone *name* pair (two
    ids sharing a name add up); trips with an unknown zone at either end are
    dropped. Columns: PickupZone, DropoffZone, TripCount.
    """
    named = _named_pairs(trips, zones, "Zone", ("PickupZone", "DropoffZone"), "TripCount", distinct_ids=True)
    counts = sum_again(named, ["PickupZone", "DropoffZone"], ["TripCount"])
    return top_k(counts, k, "-TripCount", "PickupZone", "DropoffZone")


def top_zone_pairs_by_id(trips: DataFrame, zones: DataFrame, k: int = TOP_PAIRS) -> DataFrame:
    """The ``k`` busiest (pick-up id, drop-off id) pairs, ids differing, then named.

    Counting and cutting happen per id pair *before* the lookup (the RDD
    variant), so only ``k`` rows are joined; an id missing from the lookup is
    labelled ``Unknown``. Ties in count are broken by the ids. Columns:
    PickupZone, DropoffZone, TripCount.
    """
    pairs = _pair_counts(trips, "TripCount", distinct_ids=True)
    top = top_k(pairs, k, "-TripCount", PU, DO)
    named = lookup_join(top, zones, PU, ZONE_KEY, {"Zone": "PickupZone"}, default=UNKNOWN)
    named = lookup_join(named, zones, DO, ZONE_KEY, {"Zone": "DropoffZone"}, default=UNKNOWN)
    out = sort_small(named, "-TripCount", PU, DO)  # k rows
    return out.select("PickupZone", "DropoffZone", "TripCount")


# -- Q6 ---------------------------------------------------------------------

_MONEY = {dst: src for src, dst in REVENUE_COMPONENTS}


def _totals(parts: DataFrame) -> DataFrame:
    return parts.select("Borough", *[total_of(dst).alias(dst) for dst in _MONEY])


def revenue_sums(trips: DataFrame, zones: DataFrame, default: str | None = None) -> DataFrame:
    """Unordered Q6 aggregate: eight exact sums per pick-up borough.

    Summed per zone id, then named, then summed again.
    """
    per_zone = with_parts(trips, [PU], _MONEY, MONEY_DECIMALS)
    named = lookup_join(per_zone, zones, PU, ZONE_KEY, {"Borough": "Borough"}, default=default)
    return _totals(sum_again(named, ["Borough"], [p for dst in _MONEY for p in part_names(dst)]))


def revenue_sums_once(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """The same in a single aggregation after the lookup, as a stream in complete mode needs."""
    named = lookup_join(trips, zones, PU, ZONE_KEY, {"Borough": "Borough"})
    return _totals(with_parts(named, ["Borough"], _MONEY, MONEY_DECIMALS))


def revenue_by_borough(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Eight revenue sums per pick-up borough; unmatched zones form a NULL group.

    Each column skips its own NULLs (SQL ``sum``). Columns: Borough,
    total_fare, total_tip, total_tolls, total_extra, total_mta_tax,
    total_congestion, total_airport_fee, grand_total.
    """
    return sort_total(revenue_sums(trips, zones), "-grand_total", "Borough")


def revenue_by_borough_strict(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Q6 with whole-row validity: a trip missing its zone id or any component
    is dropped (a missing airport fee counts as 0); unmatched zones are
    labelled ``Unknown``. Same columns as :func:`revenue_by_borough`."""
    required = [PU] + [src for src, _ in REVENUE_COMPONENTS if src != "airport_fee"]
    strict = (trips.withColumn("airport_fee", F.coalesce(F.col("airport_fee"), F.lit(0.0)))
              .where(" AND ".join(f"{c} IS NOT NULL" for c in required)))  # dropna would drop NaN too
    return sort_total(revenue_sums(strict, zones, default=UNKNOWN), "-grand_total", "Borough")
