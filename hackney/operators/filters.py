"""Row filters shared by several queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def nonzero_coordinates(*cols: str) -> Column:
    """All ``cols`` known and non-zero (F1, F2). ``0`` marks a missing fix;
    a NULL comparison is NULL, so NULL coordinates are dropped as well."""
    return reduce(lambda a, b: a & b, [F.col(c) != F.lit(0.0) for c in cols])


PICKUP_COORDS = ("pickup_longitude", "pickup_latitude")
DROPOFF_COORDS = ("dropoff_longitude", "dropoff_latitude")
