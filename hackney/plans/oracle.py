"""Reference SQL for every registered query, in DuckDB's dialect.

The checker pre-registers only the raw driver tables, so each statement
inlines the ``trips`` / ``zones`` fixture views as CTEs. Column names and
types match the Spark side exactly (counts cast to BIGINT). Money and means
go through exact DECIMAL sums of the values as they are; only results are
rounded.
"""

from __future__ import annotations

from hackney.sources.fixtures import (NEW_COLUMNS, OLD_COLUMNS, OLD_RULE, QUOTED_REMARKS, RAW_ABSENT_FEE_RULE, RAW_BAD, RAW_COLUMNS,
                                      RAW_EMPTY_FEE_RULE, RAW_SHORT_FIELDS, RAW_SHORT_RULE,
                                      TRIPS_SQL, ZONES_SQL)
from hackney.plans.raw import OPTIONAL, RAW_VARIANTS
from hackney.schemas import TRIPS

_PICKUP_SECS = "(l_orderkey*7919 + l_linenumber*104729 + l_partkey*31) % 86400"
_DROPOFF_SECS = (f"{_PICKUP_SECS} + 60 + (l_partkey*37 + l_suppkey*101) % 7200")


def _duckdb_trips(keyed: bool = False) -> str:
    sql = TRIPS_SQL
    sql = sql.replace(
        f"timestampadd(SECOND, CAST({_DROPOFF_SECS} AS INT), l_shipdate)",
        f"l_shipdate + to_seconds({_DROPOFF_SECS})")
    sql = sql.replace(
        f"timestampadd(SECOND, CAST({_PICKUP_SECS} AS INT), l_shipdate)",
        f"l_shipdate + to_seconds({_PICKUP_SECS})")
    assert "timestampadd" not in sql
    if keyed:
        sql = sql.replace("FROM {lineitem}", ", l_orderkey, l_linenumber\nFROM {lineitem}")
    return sql.format(lineitem="lineitem")


def _with(body: str, keyed: bool = False) -> str:
    return (f"WITH trips AS ({_duckdb_trips(keyed)}),\n"
            f"zones AS ({ZONES_SQL.format(nation='nation', region='region')})\n{body}")


def _mean(col: str) -> str:
    """The exact mean rounded to 6 places; NaN if a value is."""
    exact = f"AVG(CASE WHEN NOT isnan({col}) THEN CAST({col} AS DECIMAL(38,12)) END)"
    return f"CASE WHEN bool_or(isnan({col})) THEN CAST('NaN' AS DOUBLE) ELSE ROUND({exact}, 6) END"


def _money(col: str) -> str:
    """The exact sum as a double: whole part and fraction added."""
    total = f"SUM(CAST({col} AS DECIMAL(38,6)))"
    return f"(CAST(trunc({total}) AS DOUBLE) + CAST({total} - trunc({total}) AS DOUBLE))"


_DISTANCE = """CAST(12742 AS DOUBLE) * asin(sqrt(least(CAST(1 AS DOUBLE),
    pow(sin(radians(dropoff_latitude - pickup_latitude) / 2), 2)
    + cos(radians(pickup_latitude)) * cos(radians(dropoff_latitude))
      * pow(sin(radians(dropoff_longitude - pickup_longitude) / 2), 2))))"""

_LEGS = f"""legs AS (
  SELECT VendorID, tpep_pickup_datetime AS pu, {_DISTANCE} AS distance,
         date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) / CAST(60 AS DOUBLE) AS duration
  FROM trips
  WHERE pickup_longitude != 0 AND pickup_latitude != 0
    AND dropoff_longitude != 0 AND dropoff_latitude != 0)"""

_REVENUE = [
    ("fare_amount", "total_fare"), ("tip_amount", "total_tip"),
    ("tolls_amount", "total_tolls"), ("extra", "total_extra"),
    ("mta_tax", "total_mta_tax"), ("congestion_surcharge", "total_congestion"),
    ("airport_fee", "total_airport_fee"), ("total_amount", "grand_total"),
]
_REVENUE_SUMS = ",\n  ".join(f"{_money(src)} AS {dst}" for src, dst in _REVENUE)

_NIGHT = "(hour(tpep_pickup_datetime) = 23 OR hour(tpep_pickup_datetime) BETWEEN 0 AND 6)"


def _raw_trips(columns: list[str], strict: bool = False) -> str:
    """The rows a raw-text query parsing ``columns`` sees: bad fields are NULL, as
    is an absent fee; rows cut short are gone only if a needed field lies beyond the
    cut, and with ``strict`` rows with a bad fee."""
    rules = {name: f"({rule})" for name, (rule, _) in RAW_BAD.items()}
    rules["airport_fee"] += f" OR ({RAW_EMPTY_FEE_RULE}) OR ({RAW_ABSENT_FEE_RULE})"
    cols = [f"CASE WHEN {rules[n]} THEN NULL ELSE {n} END AS {n}" if n in rules else n
            for n in TRIPS.fieldNames()]
    arity = max(RAW_COLUMNS.index(c) for c in columns if c not in OPTIONAL) + 1
    where = [f"NOT ({RAW_SHORT_RULE})"] * (arity > RAW_SHORT_FIELDS)
    if strict:
        where.append(f"NOT ({RAW_BAD['airport_fee'][0]} AND NOT ({RAW_SHORT_RULE}))")
    return f"SELECT {', '.join(cols)} FROM trips WHERE {' AND '.join(where) or 'TRUE'}"


def _with_raw(body: str, columns: list[str], strict: bool = False) -> str:
    """``body`` evaluated over the raw-text view of the trips."""
    body = body.replace("FROM trips", "FROM raw_trips")
    sep = "" if body.lstrip().startswith(",") else "\n"
    return _with(f", raw_trips AS ({_raw_trips(columns, strict)}){sep}{body}", keyed=True)


_Q1 = f"""
SELECT CAST(hour(tpep_pickup_datetime) AS INTEGER) AS hour,
  {_mean('pickup_longitude')} AS avg_longitude, {_mean('pickup_latitude')} AS avg_latitude
FROM trips
WHERE pickup_longitude != 0 AND pickup_latitude != 0 __NULL_HOUR_RULE__
GROUP BY 1 ORDER BY 1""".lstrip("\n")

_BODIES: dict[str, str] = {
    "c0_csv_to_parquet": "SELECT * FROM trips",

    "q1_hourly_mean_pickup": _Q1.replace("__NULL_HOUR_RULE__",
                                         "AND tpep_pickup_datetime IS NOT NULL"),

    "q1_hourly_mean_pickup_null_hour": _Q1.replace("__NULL_HOUR_RULE__", ""),

    "q2_distance_sql": f""", {_LEGS}
SELECT VendorID, ROUND(MAX(distance), 6) AS max_distance_km, CAST(COUNT(*) AS BIGINT) AS n_trips
FROM legs GROUP BY 1 ORDER BY 1""",

    "q2_longest_trip_per_vendor": f""", {_LEGS},
ranked AS (SELECT *, row_number() OVER (PARTITION BY VendorID
                    ORDER BY distance DESC NULLS LAST, duration DESC NULLS LAST) AS rn FROM legs)
SELECT VendorID, ROUND(distance, 6) AS max_distance_km, duration AS trip_duration_min
FROM ranked WHERE rn = 1 ORDER BY VendorID""",

    "q2_max_and_first": f""", {_LEGS},
firsts AS (SELECT VendorID, duration, row_number() OVER (PARTITION BY VendorID
                    ORDER BY pu ASC, duration ASC NULLS FIRST) AS rn FROM legs WHERE pu IS NOT NULL)
SELECT l.VendorID, ROUND(MAX(l.distance), 6) AS max_distance_km,
       MAX(f.duration) AS first_duration_min
FROM legs l LEFT JOIN firsts f ON l.VendorID = f.VendorID AND f.rn = 1
GROUP BY l.VendorID ORDER BY l.VendorID""",

    "q3_same_borough_trips": """
SELECT pz.Borough AS PickupBorough, CAST(COUNT(*) AS BIGINT) AS TotalTrips
FROM trips t
LEFT JOIN zones pz ON t.PULocationID = pz.LocationID
LEFT JOIN zones dz ON t.DOLocationID = dz.LocationID
WHERE pz.Borough = dz.Borough
GROUP BY 1 ORDER BY TotalTrips DESC, PickupBorough""",

    "q4_night_trips_per_vendor": f"""
SELECT VendorID, CAST(COUNT(*) AS BIGINT) AS NightTripsCount
FROM trips WHERE {_NIGHT}
GROUP BY 1 ORDER BY NightTripsCount DESC, VendorID""",

    "q5_top_zone_pairs": """
SELECT pz.Zone AS PickupZone, dz.Zone AS DropoffZone, CAST(COUNT(*) AS BIGINT) AS TripCount
FROM trips t
LEFT JOIN zones pz ON t.PULocationID = pz.LocationID
LEFT JOIN zones dz ON t.DOLocationID = dz.LocationID
WHERE pz.LocationID != dz.LocationID
GROUP BY 1, 2
ORDER BY TripCount DESC, PickupZone ASC NULLS LAST, DropoffZone ASC NULLS LAST
LIMIT 20""",

    "q5_top_zone_pairs_by_id": """
, pairs AS (
  SELECT PULocationID, DOLocationID, CAST(COUNT(*) AS BIGINT) AS TripCount
  FROM trips WHERE PULocationID != DOLocationID
  GROUP BY 1, 2 ORDER BY TripCount DESC, PULocationID, DOLocationID LIMIT 20)
SELECT COALESCE(pz.Zone, 'Unknown') AS PickupZone, COALESCE(dz.Zone, 'Unknown') AS DropoffZone,
       p.TripCount
FROM pairs p
LEFT JOIN zones pz ON p.PULocationID = pz.LocationID
LEFT JOIN zones dz ON p.DOLocationID = dz.LocationID
ORDER BY p.TripCount DESC, p.PULocationID, p.DOLocationID""".lstrip("\n"),

    "q6_revenue_by_borough": f"""
SELECT z.Borough AS Borough,
  {_REVENUE_SUMS}
FROM trips t LEFT JOIN zones z ON t.PULocationID = z.LocationID
GROUP BY 1 ORDER BY grand_total DESC, Borough""",

    "q6_revenue_by_borough_unknown": f"""
, strict AS (
  SELECT * REPLACE (COALESCE(airport_fee, 0) AS airport_fee) FROM trips
  WHERE PULocationID IS NOT NULL AND fare_amount IS NOT NULL AND tip_amount IS NOT NULL
    AND tolls_amount IS NOT NULL AND extra IS NOT NULL AND mta_tax IS NOT NULL
    AND congestion_surcharge IS NOT NULL AND total_amount IS NOT NULL)
SELECT COALESCE(z.Borough, 'Unknown') AS Borough,
  {_REVENUE_SUMS}
FROM strict t LEFT JOIN zones z ON t.PULocationID = z.LocationID
GROUP BY 1 ORDER BY grand_total DESC, Borough""".lstrip("\n"),

}

ORACLE_SQL: dict[str, str] = {key: _with(sql) for key, sql in _BODIES.items()}
ORACLE_SQL["ingest_raw_trips"] = _with(_raw_trips(TRIPS.fieldNames()), keyed=True)
# Raw-text twins: the base query's body over the rows its parse keeps.
for _key, (_base, _columns) in RAW_VARIANTS.items():
    ORACLE_SQL[_key] = _with_raw(_BODIES[_base], _columns, strict=_base == "q6_revenue_by_borough_unknown")


# A trip has the columns of its file's layout alone.
ORACLE_SQL["trips_mixed_layouts"] = _with("SELECT " + ", ".join(
    c if c in OLD_COLUMNS and c in NEW_COLUMNS else
    f"CASE WHEN {OLD_RULE if c in OLD_COLUMNS else f'NOT ({OLD_RULE})'} THEN {c} END AS {c}"
    for c in TRIPS.fieldNames()) + " FROM trips", keyed=True)

_REMARK = " ".join(f"WHEN {rule} THEN {text}" for rule, text in QUOTED_REMARKS)
ORACLE_SQL["ingest_quoted_trips"] = _with(
    f"SELECT VendorID, CASE {_REMARK} END AS remark, " + ", ".join(
        f"CASE WHEN {RAW_BAD[c][0]} THEN NULL ELSE {c} END AS {c}"
        for c in ("tpep_pickup_datetime", "PULocationID", "fare_amount"))
    + f" FROM trips WHERE NOT ({RAW_SHORT_RULE})", keyed=True)

ORACLE_SQL["c0_zones_to_parquet"] = _with("SELECT LocationID, Borough, Zone FROM zones")

_ORDER = ["tpep_pickup_datetime", "tpep_dropoff_datetime"]
_ORDER += [c for c in TRIPS.fieldNames() if c not in _ORDER]
ORACLE_SQL["trips_preview"] = _with(
    f"SELECT * FROM trips ORDER BY {', '.join(f'{c} ASC NULLS LAST' for c in _ORDER)} LIMIT 20")

ORACLE_SQL["q6_revenue_report"] = _with("SELECT substr(z.Borough, 1, 12) AS Borough, " + ", ".join(
    f"CAST(ROUND(SUM(CAST({src} AS DECIMAL(38,6))), 2) AS DOUBLE) AS {dst}" for src, dst in _REVENUE)
    + " FROM trips t LEFT JOIN zones z ON t.PULocationID = z.LocationID GROUP BY 1")
