"""Explicit schemas for the trip tables and the zone lookup.

Reading text with an explicit schema avoids the extra inference pass and pins
types (e.g. timestamps as TIMESTAMP_NTZ: trip times are wall-clock values,
independent of the session time zone).
"""

from __future__ import annotations

from pyspark.sql import types as T

# Trips in the zone-id layout (the 2024 files) plus the coordinate columns of
# the 2015 layout; every query resolves columns by name, never by position.
TRIPS = T.StructType([
    T.StructField("VendorID", T.IntegerType()),
    T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
    T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
    T.StructField("pickup_longitude", T.DoubleType()),
    T.StructField("pickup_latitude", T.DoubleType()),
    T.StructField("dropoff_longitude", T.DoubleType()),
    T.StructField("dropoff_latitude", T.DoubleType()),
    T.StructField("PULocationID", T.IntegerType()),
    T.StructField("DOLocationID", T.IntegerType()),
    T.StructField("fare_amount", T.DoubleType()),
    T.StructField("tip_amount", T.DoubleType()),
    T.StructField("tolls_amount", T.DoubleType()),
    T.StructField("extra", T.DoubleType()),
    T.StructField("mta_tax", T.DoubleType()),
    T.StructField("congestion_surcharge", T.DoubleType()),
    T.StructField("airport_fee", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
])

ZONES = T.StructType([
    T.StructField("LocationID", T.IntegerType()),
    T.StructField("Borough", T.StringType()),
    T.StructField("Zone", T.StringType()),
])

# Fixed values (must equal the reference's): the revenue components summed per
# borough, in report order, with their output column names.
REVENUE_COMPONENTS = [
    ("fare_amount", "total_fare"),
    ("tip_amount", "total_tip"),
    ("tolls_amount", "total_tolls"),
    ("extra", "total_extra"),
    ("mta_tax", "total_mta_tax"),
    ("congestion_surcharge", "total_congestion"),
    ("airport_fee", "total_airport_fee"),
    ("total_amount", "grand_total"),
]

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
