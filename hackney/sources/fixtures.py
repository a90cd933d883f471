"""Trip and zone views over the driver's TPC-H-style test tables.

The test data has no taxi table, so ``trips`` is a deterministic projection of
``lineitem`` and ``zones`` one of ``nation``/``region`` (definitions shared
with the DuckDB oracle in ``hackney.plans.oracle``). Both are lazy SQL views:
Catalyst prunes the lineitem columns each query does not touch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hackney.schemas import TRIPS
from hackney.session import table_path

# Fixed fixture definition: the trips view over lineitem (Spark SQL dialect).
TRIPS_SQL = """
SELECT CAST(1 + l_linenumber % 2 AS INT) AS VendorID,
  CASE WHEN l_orderkey % 89 = 0 THEN NULL ELSE timestampadd(SECOND, CAST((l_orderkey*7919 + l_linenumber*104729 + l_partkey*31) % 86400 AS INT), l_shipdate) END AS tpep_pickup_datetime,
  timestampadd(SECOND, CAST((l_orderkey*7919 + l_linenumber*104729 + l_partkey*31) % 86400 + 60 + (l_partkey*37 + l_suppkey*101) % 7200 AS INT), l_shipdate) AS tpep_dropoff_datetime,
  CASE WHEN l_partkey % 50 = 0 THEN CAST(0 AS DOUBLE) WHEN l_partkey % 53 = 0 THEN NULL
       ELSE (-74250 + (l_partkey*173 + l_linenumber*7) % 550) / CAST(1000 AS DOUBLE)
            + (l_orderkey % 997) / CAST(100000000000 AS DOUBLE) END AS pickup_longitude,
  CASE WHEN l_partkey % 50 = 0 THEN CAST(0 AS DOUBLE)
       ELSE (40500 + (l_partkey*89 + l_orderkey*13) % 410) / CAST(1000 AS DOUBLE)
            + (l_orderkey % 991) / CAST(10000000 AS DOUBLE) END AS pickup_latitude,
  CASE WHEN l_suppkey % 40 = 0 THEN CAST(0 AS DOUBLE)
       ELSE (-74250 + (l_suppkey*61 + l_orderkey*11) % 550) / CAST(1000 AS DOUBLE) END AS dropoff_longitude,
  CASE WHEN l_suppkey % 40 = 0 THEN CAST(0 AS DOUBLE)
       ELSE (40500 + (l_suppkey*97 + l_linenumber*17) % 410) / CAST(1000 AS DOUBLE) END AS dropoff_latitude,
  CAST(l_partkey % 27 AS INT) AS PULocationID,
  CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE CAST(l_suppkey % 26 AS INT) END AS DOLocationID,
  l_extendedprice + l_linenumber / CAST(1000 AS DOUBLE) AS fare_amount, l_quantity AS tip_amount,
  CAST(CASE WHEN l_orderkey % 20 = 0 THEN 6.94 ELSE 0 END AS DOUBLE) AS tolls_amount,
  l_discount AS extra, l_tax AS mta_tax,
  CAST(2.5 AS DOUBLE) AS congestion_surcharge,
  CAST(CASE l_partkey % 10 WHEN 0 THEN 1.25 WHEN 1 THEN NULL ELSE 0 END AS DOUBLE) AS airport_fee,
  l_extendedprice + l_quantity AS total_amount
FROM {lineitem}
"""

# Fixed fixture definition: the zone lookup over nation/region (both dialects).
ZONES_SQL = """
SELECT n_nationkey AS LocationID, r_name AS Borough,
  CASE WHEN n_nationkey IN (3, 4) THEN 'NATION_3' ELSE n_name END AS Zone
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
"""


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (S5: Parquet scan)."""
    return spark.read.parquet(table_path(sf_dir, name))


def spread_lineitem(spark: SparkSession, sf_dir: str, rows_per_task: int) -> DataFrame:
    """lineitem for work that costs much a row, dealt anew where one task would read much more than its share.

    A Parquet row group is read by one task, however large, and other splits of its file are empty.
    How many rows a task has is told by the footers. The keys deal the rows, so none is sorted for it.
    """
    lineitem = read_table(spark, sf_dir, "lineitem")
    counts = lineitem.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n"))
    total, most = counts.agg(F.sum("n"), F.max("n")).first()
    if not total or most <= 2 * rows_per_task:
        return lineitem
    return lineitem.repartition(-(-2 * total // rows_per_task), "l_orderkey", "l_linenumber")


def trips(spark: SparkSession, sf_dir: str, rows_per_task: int | None = None) -> DataFrame:
    """The ``trips`` fact view (zone-id + coordinate columns) over lineitem, spread if ``rows_per_task`` is given."""
    lineitem = read_table(spark, sf_dir, "lineitem") if rows_per_task is None else spread_lineitem(spark, sf_dir, rows_per_task)
    return spark.sql(TRIPS_SQL, lineitem=lineitem)


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``zones`` lookup (LocationID, Borough, Zone) over nation/region."""
    return spark.sql(ZONES_SQL,
                     nation=read_table(spark, sf_dir, "nation"),
                     region=read_table(spark, sf_dir, "region"))


# -- raw text fixture ---------------------------------------------------------
# Fixed fixture rules (shared with the DuckDB oracle): which rendered lines get
# an unparseable field, which are cut short after their first RAW_SHORT_FIELDS
# fields, and whose fee (the last column of the files) is bad, empty or absent.
RAW_COLUMNS = [*[c for c in TRIPS.fieldNames() if c != "airport_fee"], "airport_fee"]
RAW_BAD = {"tpep_pickup_datetime": ("(l_orderkey + l_linenumber) % 17 = 0", "bad"),
           "PULocationID": ("(l_orderkey * 5 + l_linenumber) % 31 = 0", "zone?"),
           "fare_amount": ("(l_orderkey * 7 + l_linenumber) % 37 = 0", "n/a"),
           "airport_fee": ("(l_orderkey * 11 + l_linenumber) % 23 = 0", "x")}
RAW_EMPTY_FEE_RULE = "(l_orderkey * 11 + l_linenumber) % 23 = 1"
RAW_ABSENT_FEE_RULE = "(l_orderkey * 11 + l_linenumber) % 23 = 2"
RAW_SHORT_RULE = "(l_orderkey * 3 + l_linenumber) % 29 = 0"
RAW_SHORT_FIELDS = 8
RAW_REPEATED_HEADERS = 3  # extra header lines written as data


def keyed_trips(spark: SparkSession, sf_dir: str, rows_per_task: int | None = None) -> DataFrame:
    """``trips`` plus the lineitem key (l_orderkey, l_linenumber) of each row, spread if ``rows_per_task`` is given."""
    lineitem = read_table(spark, sf_dir, "lineitem") if rows_per_task is None else spread_lineitem(spark, sf_dir, rows_per_task)
    sql = TRIPS_SQL.replace("FROM {lineitem}", ", l_orderkey, l_linenumber\nFROM {lineitem}")
    return spark.sql(sql, lineitem=lineitem)


def write_raw_trips(spark: SparkSession, sf_dir: str, path: str,
                    max_records_per_file: int | None = None) -> str:
    """Render ``trips`` as header-led CSV text under ``path``.

    Every output file starts with the header line (as Spark's CSV writer does
    for each part file); ``max_records_per_file`` cuts a task's output into
    several such files. A few extra header lines are appended as data, so
    one file repeats the header after its first line. The rules above inject
    bad fields, short rows and rows that end before the fee.
    """
    header = ",".join(RAW_COLUMNS)
    keyed = keyed_trips(spark, sf_dir, max_records_per_file)
    parts = []
    for name in RAW_COLUMNS:
        # A TIMESTAMP_NTZ cast to text is 'yyyy-MM-dd HH:mm:ss' whatever the
        # session zone (date_format would pass through the session zone and
        # move wall-clock times inside a DST gap).
        text = F.coalesce(F.col(name).cast("string"), F.lit(""))
        if name in RAW_BAD:
            rule, bad = RAW_BAD[name]
            text = F.when(F.expr(rule), F.lit(bad)).otherwise(text)
        if name == "airport_fee":
            text = F.when(F.expr(RAW_EMPTY_FEE_RULE), F.lit("")).otherwise(text)
        parts.append(text)
    line = (F.when(F.expr(RAW_SHORT_RULE), F.concat_ws(",", *parts[:RAW_SHORT_FIELDS]))
            .when(F.expr(RAW_ABSENT_FEE_RULE), F.concat_ws(",", *parts[:-1]))
            .otherwise(F.concat_ws(",", *parts)))
    repeated = spark.range(RAW_REPEATED_HEADERS).select(F.lit(header).alias(header))
    # A one-column CSV whose column is named after the header line: the writer
    # puts that name atop every file. The separator never occurs in a line, so
    # commas are written as-is, unquoted.
    (keyed.select(line.alias(header)).unionByName(repeated)
     .write.mode("overwrite")
     .options(header="true", sep="\u0001", quote="", escapeQuotes="false",
              maxRecordsPerFile=str(max_records_per_file or 0))
     .csv(path))
    return path


# -- files of two layouts in one folder ------------------------------------------
# Fixed fixture rules (shared with the DuckDB oracle): even orders are written in
# the coordinate layout, odd ones in the zone-id layout, whose columns stand in
# another order, with 64-bit ids and another spelling of the fee.
OLD_RULE = "l_orderkey % 2 = 0"
OLD_COLUMNS = ["VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "pickup_longitude", "pickup_latitude",
               "dropoff_longitude", "dropoff_latitude", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
               "total_amount"]
NEW_COLUMNS = ["tpep_pickup_datetime", "tpep_dropoff_datetime", "VendorID", "DOLocationID", "PULocationID", "total_amount",
               "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "congestion_surcharge", "airport_fee"]


def write_mixed_trips(spark: SparkSession, sf_dir: str, path: str, fmt: str, max_records_per_file: int) -> str:
    """``trips`` in one folder: files of the coordinate layout and of the zone-id layout (CSV or Parquet)."""
    keyed = keyed_trips(spark, sf_dir, max_records_per_file)
    wide = {"VendorID": "bigint", "DOLocationID": "bigint", "PULocationID": "bigint"}
    new = [F.col(c).cast(wide.get(c, TRIPS[c].dataType)).alias("Airport_fee" if c == "airport_fee" else c)
           for c in NEW_COLUMNS]
    halves = [keyed.where(OLD_RULE).select(*OLD_COLUMNS), keyed.where(f"NOT ({OLD_RULE})").select(*new)]
    for mode, half in zip(("overwrite", "append"), halves, strict=True):
        # A TIMESTAMP_NTZ as text has no zone; see write_raw_trips.
        half = half if fmt == "parquet" else half.withColumns(
            {c: F.col(c).cast("string") for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime")})
        options = {"maxRecordsPerFile": str(max_records_per_file)} | ({} if fmt == "parquet" else {"header": "true"})
        half.write.mode(mode).options(**options).format(fmt).save(path)
    return path


# -- text with quoted fields -------------------------------------------------------
# Fixed fixture rules (shared with the DuckDB oracle): lines with a remark, which
# is quoted in some; bad fields and rows cut short by the rules above.
QUOTED_COLUMNS = ["VendorID", "remark", "tpep_pickup_datetime", "PULocationID", "fare_amount", "total_amount"]
QUOTED_SCHEMA = "VendorID INT, remark STRING, tpep_pickup_datetime TIMESTAMP_NTZ, PULocationID INT, fare_amount DOUBLE"
QUOTED_REMARKS = [("l_orderkey % 5 = 0", """concat('zone ', PULocationID, ', "kerb" side, ', VendorID)"""),
                  ("l_orderkey % 5 = 1", "concat('paid, twice ', l_linenumber)"),
                  ("l_orderkey % 5 = 2", "concat('plain ', l_orderkey % 7)")]
QUOTED_SHORT_FIELDS = 4


def write_quoted_trips(spark: SparkSession, sf_dir: str, path: str, max_records_per_file: int) -> str:
    """Header-led text lines whose remarks, and some fares, stand in double quotes."""
    quote = lambda x: F.concat(F.lit('"'), F.replace(x, F.lit('"'), F.lit('""')), F.lit('"'))
    remark = F.lit("")
    for rule, text in QUOTED_REMARKS:
        remark = F.when(F.expr(rule), quote(F.expr(text))).otherwise(remark)
    parts = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in QUOTED_COLUMNS if c != "remark"}
    for name in ("tpep_pickup_datetime", "PULocationID", "fare_amount"):
        rule, bad = RAW_BAD[name]
        parts[name] = F.when(F.expr(rule), F.lit(bad)).otherwise(parts[name])
    parts["fare_amount"] = F.when(F.expr("l_linenumber = 3"), quote(parts["fare_amount"])).otherwise(parts["fare_amount"])
    fields = [remark if c == "remark" else parts[c] for c in QUOTED_COLUMNS]
    line = (F.when(F.expr(RAW_SHORT_RULE), F.concat_ws(",", *fields[:QUOTED_SHORT_FIELDS]))
            .otherwise(F.concat_ws(",", *fields)))
    (keyed_trips(spark, sf_dir, max_records_per_file).select(line.alias(",".join(QUOTED_COLUMNS))).write.mode("overwrite")
     .options(header="true", sep="\u0001", quote="", escapeQuotes="false", maxRecordsPerFile=str(max_records_per_file))
     .csv(path))
    return path
