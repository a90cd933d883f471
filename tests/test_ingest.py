"""Sources: typed CSV, CSV -> Parquet, raw text with malformed rows."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from hackney.plans import queries as Q
from hackney.schemas import TRIPS, ZONES
from hackney.sources import files, fixtures, rawtext
from tests.conftest import SF_SMALL, ts

HEADER = ",".join(TRIPS.fieldNames())


def _write(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as fh:
        fh.write("\n".join(lines) + "\n")


def _line(vendor, pickup, pu="1", do="2", fare="10.0", fee=""):
    fields = {n: "" for n in TRIPS.fieldNames()}
    fields.update(VendorID=vendor, tpep_pickup_datetime=pickup,
                  tpep_dropoff_datetime="2024-01-01 23:59:00", PULocationID=pu,
                  DOLocationID=do, fare_amount=fare, airport_fee=fee)
    return ",".join(fields[n] for n in TRIPS.fieldNames())


def test_raw_text_header_guard_and_try_parse(spark, tmp_dir):
    _write(tmp_dir, "part-0.csv", [
        HEADER,
        _line("1", "2024-01-01 23:10:00"),
        _line("2", "bad"),                                  # unparseable time -> NULL
        HEADER,                                             # repeated header mid-file
        _line("1", "2024-01-01 05:00:00", fare="x"),        # unparseable fare -> NULL
        "1,2024-01-01 02:00:00,2024-01-01 02:10:00",        # short row
        _line("2", "2024-1-1 5:00:00"),                     # parts need no padding
    ])
    _write(tmp_dir, "part-1.csv", [HEADER, _line("2", "2024-01-01 01:00:00", fee="1.25")])
    full = rawtext.ingest(spark, tmp_dir, TRIPS)
    rows = sorted(full.collect(), key=lambda r: (r.VendorID, str(r.tpep_pickup_datetime)))
    assert len(rows) == 5                                   # header lines and short row gone
    assert [r.tpep_pickup_datetime for r in rows if r.VendorID == 2].count(None) == 1
    assert [r.fare_amount for r in rows if r.VendorID == 1] == [None, 10.0]
    assert [r.airport_fee for r in rows if r.VendorID == 2 and r.airport_fee] == [1.25]
    assert full.schema == TRIPS

    strict = rawtext.ingest(spark, tmp_dir, TRIPS, drop_malformed=True)
    assert strict.count() == 3                              # 'bad' and 'x' rows dropped

    # A query that needs only the first two fields keeps the short row.
    two = rawtext.ingest(spark, tmp_dir, TRIPS, columns=["VendorID", "tpep_pickup_datetime"])
    assert two.count() == 6
    night = {r.VendorID: r.NightTripsCount for r in Q.night_trips_per_vendor(two).collect()}
    assert night == {1: 3, 2: 2}


def test_raw_text_missing_column_is_an_error(spark, tmp_dir):
    _write(tmp_dir, "a.csv", ["a,b", "1,2"])
    with pytest.raises(ValueError):
        rawtext.ingest(spark, tmp_dir, TRIPS)


def test_raw_text_header_comes_from_the_file(spark, tmp_dir):
    """Columns in another order and a quoted header: fields are found by their names."""
    _write(f"{tmp_dir}/a", "part-0.csv", ["fare_amount,VendorID,PULocationID,total_amount", "1.0,1,5,2.0",
                                          "fare_amount,VendorID,PULocationID,total_amount"])
    row = rawtext.ingest(spark, f"{tmp_dir}/a", TRIPS, columns=["VendorID", "PULocationID", "total_amount"]).collect()
    assert [tuple(r) for r in row] == [(1, 5, 2.0)]
    _write(f"{tmp_dir}/b", "part-0.csv", ['"VendorID","PULocationID"', "1,5"])
    assert [tuple(r) for r in rawtext.ingest(spark, f"{tmp_dir}/b", TRIPS, columns=["VendorID", "PULocationID"]).collect()] \
        == [(1, 5)]


def test_raw_text_optional_last_column_and_minimum_of_fields(spark, tmp_dir):
    """Q6 over text: an empty or absent fee is 0, a bad one drops the row."""
    from tests.conftest import make_zones
    names = [*[c for c in TRIPS.fieldNames() if c != "airport_fee"], "airport_fee"]
    base = {n: "1" for n in names} | {"tpep_pickup_datetime": "2024-01-01 10:00:00", "PULocationID": "1", "fare_amount": "10"}
    line = lambda fee: ",".join([base[n] for n in names[:-1]] + ([fee] if fee is not None else []))
    _write(f"{tmp_dir}/t", "part-0.csv", [",".join(names), line("1.25"), line(""), line(None), line("x"), "1,2"])
    from hackney.plans import raw
    strict = raw.read_trips(spark, f"{tmp_dir}/t", "q6_revenue_by_borough_unknown")
    row = Q.revenue_by_borough_strict(strict, make_zones(spark, [(1, "A", "a")])).first()
    assert (row.total_fare, row.total_airport_fee) == (30.0, 1.25)
    lenient = raw.read_trips(spark, f"{tmp_dir}/t", "q6_revenue_by_borough")
    assert lenient.count() == 4
    columns = ["VendorID"]
    assert rawtext.ingest(spark, f"{tmp_dir}/t", TRIPS, columns=columns).count() == 5
    assert rawtext.ingest(spark, f"{tmp_dir}/t", TRIPS, columns=columns, min_fields=len(names)).count() == 3


def test_csv_is_quote_aware_where_naive_split_is_not(spark, tmp_dir):
    _write(tmp_dir, "zones.csv", ['LocationID,Borough,Zone', '1,Manhattan,"Alphabet City, East"',
                                  '2,Queens,JFK Airport'])
    typed = files.read_csv(spark, tmp_dir, schema=ZONES)
    assert typed.where(F.col("LocationID") == 1).first().Zone == "Alphabet City, East"
    naive = rawtext.ingest(spark, tmp_dir, ZONES)
    assert naive.where(F.col("LocationID") == 1).first().Zone == '"Alphabet City'


def test_csv_header_resolves_by_name(spark, tmp_dir):
    _write(tmp_dir, "zones.csv", ["Zone,LocationID,Borough", "JFK,2,Queens"])
    row = files.read_csv(spark, tmp_dir, schema=ZONES).first()
    assert (row.LocationID, row.Borough, row.Zone) == (2, "Queens", "JFK")


def test_csv_infer_schema_option(spark, tmp_dir):
    _write(tmp_dir, "zones.csv", ["LocationID,Borough,Zone", "2,Queens,JFK"])
    inferred = files.read_csv(spark, tmp_dir, infer_schema=True)
    assert dict(inferred.dtypes)["LocationID"] == "int"


def test_csv_to_parquet_round_trip_is_lossless(spark, tmp_dir):
    trips = fixtures.trips(spark, SF_SMALL)
    csv_dir = files.write_csv(trips, f"{tmp_dir}/csv")
    out = files.csv_to_parquet(spark, [(csv_dir, f"{tmp_dir}/pq")], schemas={f"{tmp_dir}/pq": TRIPS})
    back = files.read_parquet(spark, out[0])
    assert back.schema == TRIPS
    assert back.exceptAll(trips).count() == 0 and trips.exceptAll(back).count() == 0


def test_parquet_partitioned_write_prunes(spark, tmp_dir):
    trips = fixtures.trips(spark, SF_SMALL).withColumn("year", F.year("tpep_pickup_datetime"))
    files.write_parquet(trips, f"{tmp_dir}/pq", partition_by=["year"])
    df = files.read_parquet(spark, f"{tmp_dir}/pq").where(F.col("year") == 1996)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert df.count() == trips.where(F.col("year") == 1996).count()


@pytest.mark.parametrize("query", ["hourly_mean_pickup", "longest_trip_per_vendor",
                                   "night_trips_per_vendor"])
def test_csv_source_equals_parquet_source(spark, tmp_dir, query):
    trips = fixtures.trips(spark, SF_SMALL)
    csv_dir = files.write_csv(trips, f"{tmp_dir}/csv")
    from_csv = getattr(Q, query)(files.read_csv(spark, csv_dir, schema=TRIPS)).collect()
    assert from_csv == getattr(Q, query)(trips).collect()


@pytest.mark.parametrize("query", ["same_borough_trips", "top_zone_pairs", "revenue_by_borough"])
def test_csv_source_equals_parquet_source_with_zones(spark, tmp_dir, query):
    trips, zones = fixtures.trips(spark, SF_SMALL), fixtures.zones(spark, SF_SMALL)
    t_csv = files.write_csv(trips, f"{tmp_dir}/t")
    z_csv = files.write_csv(zones, f"{tmp_dir}/z")
    fn = getattr(Q, query)
    from_csv = fn(files.read_csv(spark, t_csv, schema=TRIPS), files.read_csv(spark, z_csv, schema=ZONES))
    assert from_csv.collect() == fn(trips, zones).collect()


def test_raw_fixture_has_headers_inside_files(spark, tmp_dir):
    path = fixtures.write_raw_trips(spark, SF_SMALL, f"{tmp_dir}/raw", max_records_per_file=2000)
    lines = rawtext.read_lines(spark, path).withColumn("file", F.input_file_name())
    n_files = lines.select("file").distinct().count()
    assert n_files >= 4                                     # 6000 rows, 2000 per file + headers
    headers = lines.where(F.col("value") == ",".join(fixtures.RAW_COLUMNS))
    assert headers.count() == n_files + fixtures.RAW_REPEATED_HEADERS
    assert headers.select("file").distinct().count() == n_files   # atop every file
    parsed = rawtext.ingest(spark, path, TRIPS, optional=["airport_fee"])
    for name, (rule, _) in fixtures.RAW_BAD.items():        # every bad field is there
        assert fixtures.keyed_trips(spark, SF_SMALL).where(rule).count() > 0, name
    strict = rawtext.ingest(spark, path, TRIPS, optional=["airport_fee"], drop_malformed=True)
    assert strict.count() < parsed.count()
    assert parsed.where(F.col("tpep_pickup_datetime").isNull()).count() > 0
    assert parsed.count() < fixtures.trips(spark, SF_SMALL).count()
    assert lines.where(F.col("value").contains('"')).count() == 0   # nothing quoted


def test_timestamps_parse_strictly(spark):
    df = spark.createDataFrame([("2024-02-29 12:00:00",), ("2024-02-30 12:00:00",), ("",),
                                ("2024-01-01T12:00:00",)], "s string")
    out = [r.t for r in df.select(rawtext.parse_field(F.col("s"), TRIPS["tpep_pickup_datetime"].dataType)
                                  .alias("t")).collect()]
    assert out == [ts("2024-02-29 12:00:00"), None, None, None]


def test_csv_missing_optional_column_is_null(spark, tmp_dir):
    _write(tmp_dir, "zones.csv", ["locationid,BOROUGH", "2,Queens"])
    row = files.read_csv(spark, tmp_dir, schema=ZONES).first()
    assert (row.LocationID, row.Borough, row.Zone) == (2, "Queens", None)


def test_parquet_conform_handles_both_layouts(spark, tmp_dir):
    # A zone-id layout file (no coordinates, capitalised fee, bigint vendor)
    # and a coordinate layout file read under one schema.
    spark.createDataFrame([(2, ts("2024-01-01 01:00:00"), 132, 1.75)],
                          "VendorID bigint, tpep_pickup_datetime timestamp_ntz, "
                          "PULocationID int, Airport_fee double").write.parquet(f"{tmp_dir}/y2024")
    spark.createDataFrame([(1, ts("2015-01-01 23:00:00"), -73.9, 40.7)],
                          "VendorID int, tpep_pickup_datetime timestamp_ntz, "
                          "pickup_longitude double, pickup_latitude double"
                          ).write.parquet(f"{tmp_dir}/y2015")
    a = files.read_parquet(spark, f"{tmp_dir}/y2024", schema=TRIPS).first()
    b = files.read_parquet(spark, f"{tmp_dir}/y2015", schema=TRIPS).first()
    assert (a.VendorID, a.airport_fee, a.pickup_longitude) == (2, 1.75, None)
    assert (b.VendorID, b.pickup_longitude, b.PULocationID) == (1, -73.9, None)
    night = Q.night_trips_per_vendor(files.read_parquet(spark, f"{tmp_dir}/y2024", schema=TRIPS))
    assert [tuple(r) for r in night.collect()] == [(2, 1)]


def test_raw_text_round_trip_ignores_session_time_zone(spark, tmp_dir):
    """Wall-clock times inside a DST gap survive text and back in any zone."""
    from hackney.plans.oracle import ORACLE_SQL
    from tests.conftest import SF_ORACLE
    from tools.oracle_check import compare, duck_connection
    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        path = fixtures.write_raw_trips(spark, SF_ORACLE, f"{tmp_dir}/raw")
        parsed = rawtext.ingest(spark, path, TRIPS, optional=["airport_fee"])
        res = compare(parsed, duck_connection(SF_ORACLE), ORACLE_SQL["ingest_raw_trips"])
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    assert res["ok"], res


def test_derived_text_is_rendered_by_many_tasks_from_one_row_group(spark, tmp_path):
    """A row group is one task's, however large; rendering its rows is dealt out, and gives the same rows."""
    source, root = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet"), str(tmp_path / "one")
    source.coalesce(1).write.parquet(f"{root}/lineitem.parquet")
    path = fixtures.write_raw_trips(spark, root, str(tmp_path / "raw"), max_records_per_file=10_000)
    names = spark.read.text(path).inputFiles()
    assert len({name.rsplit("part-", 1)[1][:5] for name in names}) >= 8
    plain = fixtures.write_raw_trips(spark, root, str(tmp_path / "plain"))
    rows = lambda folder: spark.read.text(folder).where("value NOT LIKE 'VendorID,%'")
    assert rows(path).exceptAll(rows(plain)).isEmpty() and rows(path).count() == rows(plain).count() == source.count()
