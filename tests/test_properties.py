"""Cross-query invariants on the sf0.01 fixture."""

from __future__ import annotations

from pyspark.sql import functions as F

from hackney.functions import is_night, total_of, with_parts
from hackney.functions.numeric import MONEY_DECIMALS
from hackney.plans import queries as Q
from hackney.schemas import REVENUE_COMPONENTS
from hackney.sources import fixtures
from tests.conftest import SF_ORACLE


def test_q6_groups_add_up_to_global_sums(spark):
    trips = fixtures.trips(spark, SF_ORACLE)
    zones = fixtures.zones(spark, SF_ORACLE)
    per_borough = Q.revenue_by_borough(trips, zones)
    totals = per_borough.agg(*[F.sum(dst).alias(dst) for _, dst in REVENUE_COMPONENTS]).first()
    parts = with_parts(trips, [], {dst: src for src, dst in REVENUE_COMPONENTS}, MONEY_DECIMALS)
    overall = parts.select(*[total_of(dst).alias(dst) for _, dst in REVENUE_COMPONENTS]).first()
    for _, dst in REVENUE_COMPONENTS:
        assert round(totals[dst], 2) == round(overall[dst], 2)


def test_q4_night_plus_day_is_all_timed_trips(spark):
    trips = fixtures.trips(spark, SF_ORACLE)
    night = sum(r.NightTripsCount for r in Q.night_trips_per_vendor(trips).collect())
    day = trips.where(~is_night("tpep_pickup_datetime")).count()
    timed = trips.where(F.col("tpep_pickup_datetime").isNotNull()).count()
    assert night + day == timed


def test_q3_same_plus_other_plus_unmatched_is_all(spark):
    trips = fixtures.trips(spark, SF_ORACLE)
    zones = fixtures.zones(spark, SF_ORACLE)
    same = sum(r.TotalTrips for r in Q.same_borough_trips(trips, zones).collect())
    z = zones.select("LocationID", "Borough")
    j = (trips.join(z.withColumnRenamed("LocationID", "PULocationID")
                     .withColumnRenamed("Borough", "pb"), "PULocationID", "left")
         .join(z.withColumnRenamed("LocationID", "DOLocationID")
               .withColumnRenamed("Borough", "db"), "DOLocationID", "left"))
    other = j.where(F.col("pb") != F.col("db")).count()
    unmatched = j.where(F.col("pb").isNull() | F.col("db").isNull()).count()
    assert same + other + unmatched == trips.count()


def test_q5_by_name_total_never_below_by_id_head(spark):
    trips = fixtures.trips(spark, SF_ORACLE)
    zones = fixtures.zones(spark, SF_ORACLE)
    by_name = Q.top_zone_pairs(trips, zones).collect()
    by_id = Q.top_zone_pairs_by_id(trips, zones).collect()
    # Merging ids under one name can only grow a pair's count.
    assert by_name[0].TripCount >= by_id[0].TripCount
