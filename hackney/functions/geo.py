"""Great-circle distance as a native Column expression.

The haversine formula built from ``radians/sin/cos/asin/sqrt`` stays inside
whole-stage codegen; a Python UDF would ship every row to a Python worker.
For SQL users the same formula is registered as a SQL function, which the
analyzer inlines (no Python in the plan either).
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in kilometres used by the trip queries.
EARTH_RADIUS_KM = 6371.0


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def haversine_km(lon1, lat1, lon2, lat2) -> Column:
    """Great-circle distance in km between two (lon, lat) points in degrees.

    ``a`` is clamped to [0, 1]: rounding can push it a hair above 1 for
    antipodal points, where ``asin`` would return NaN.
    """
    phi1, phi2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dphi = F.radians(_c(lat2) - _c(lat1))
    dlmb = F.radians(_c(lon2) - _c(lon1))
    a = (F.pow(F.sin(dphi / 2), 2)
         + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin(dlmb / 2), 2))
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def register_sql_functions(spark: SparkSession) -> None:
    """Register ``haversine_km`` as a temporary SQL function (U1 for SQL users)."""
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION haversine_km(
            lon1 DOUBLE, lat1 DOUBLE, lon2 DOUBLE, lat2 DOUBLE)
        RETURNS DOUBLE
        RETURN {2 * EARTH_RADIUS_KM} * asin(sqrt(least(1.0D,
            pow(sin(radians(lat2 - lat1) / 2), 2)
            + cos(radians(lat1)) * cos(radians(lat2))
              * pow(sin(radians(lon2 - lon1) / 2), 2))))
    """)
