"""Incremental aggregates: restart from the checkpoint, new files only."""

from __future__ import annotations

from pyspark.sql import functions as F

from hackney import streaming
from hackney.plans import queries as Q
from hackney.sources import files, fixtures
from tests.conftest import SF_SMALL


def _rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_stream_restarts_from_checkpoint_and_counts_each_file_once(spark, tmp_dir):
    trips = fixtures.trips(spark, SF_SMALL)
    zones = fixtures.zones(spark, SF_SMALL)
    first, second = trips.where(F.col("VendorID") == 1), trips.where(F.col("VendorID") == 2)
    src, ckpt_q4, ckpt_q6 = f"{tmp_dir}/src", f"{tmp_dir}/ck4", f"{tmp_dir}/ck6"
    out_q4, out_q6 = f"{tmp_dir}/q4", f"{tmp_dir}/q6"

    files.write_parquet(first.repartition(3), src)

    def run():
        stream = streaming.trip_stream(spark, src, max_files_per_trigger=1)
        streaming.run_to_table(streaming.night_trips_stream(stream), out_q4, ckpt_q4)
        stream = streaming.trip_stream(spark, src, max_files_per_trigger=1)
        streaming.run_to_table(streaming.revenue_stream(stream, zones), out_q6, ckpt_q6)

    run()
    assert _rows(streaming.read_table(spark, out_q4), "VendorID") == \
        _rows(Q.night_trips_per_vendor(first), "VendorID")

    files.write_parquet(second.repartition(2), src, mode="append")
    run()  # same checkpoints: only the new files are read
    assert _rows(streaming.read_table(spark, out_q4), "VendorID") == \
        _rows(Q.night_trips_per_vendor(trips), "VendorID")
    assert _rows(streaming.read_table(spark, out_q6), "Borough") == \
        _rows(Q.revenue_by_borough(trips, zones), "Borough")


def test_csv_stream_source(spark, tmp_dir):
    trips = fixtures.trips(spark, SF_SMALL)
    csv_dir = files.write_csv(trips.repartition(2), f"{tmp_dir}/csv")
    stream = streaming.trip_stream(spark, csv_dir, fmt="csv")
    streaming.run_to_table(streaming.night_trips_stream(stream), f"{tmp_dir}/out",
                           f"{tmp_dir}/ck")
    assert _rows(streaming.read_table(spark, f"{tmp_dir}/out"), "VendorID") == \
        _rows(Q.night_trips_per_vendor(trips), "VendorID")


def test_csv_stream_resolves_columns_by_header_name(spark, tmp_dir):
    import os
    os.makedirs(f"{tmp_dir}/src")
    with open(f"{tmp_dir}/src/a.csv", "w") as fh:     # reordered, capitalised, extra column
        fh.write("tpep_pickup_datetime,passenger_count,VENDORID\n"
                 "2024-01-01 23:30:00,1,2\n2024-01-01 12:00:00,3,1\n2024-01-02 01:00:00,1,2\n")
    stream = streaming.trip_stream(spark, f"{tmp_dir}/src", fmt="csv")
    streaming.run_to_table(streaming.night_trips_stream(stream), f"{tmp_dir}/out",
                           f"{tmp_dir}/ck")
    assert _rows(streaming.read_table(spark, f"{tmp_dir}/out"), "VendorID") == [(2, 2)]


def test_stream_leaves_the_callers_settings_and_a_whole_table(spark, tmp_dir):
    from pyspark.sql import SparkSession
    before = spark.conf.get("spark.sql.shuffle.partitions")
    session = streaming.stream_session(spark, 3)
    assert isinstance(session, SparkSession) and session.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    trips = fixtures.trips(spark, SF_SMALL)
    files.write_parquet(trips.repartition(4), f"{tmp_dir}/src")
    stream = streaming.trip_stream(session, f"{tmp_dir}/src", max_files_per_trigger=1)
    query = streaming.run_to_table(streaming.night_trips_stream(stream), f"{tmp_dir}/out")
    assert len(query.recentProgress) >= 4                     # one micro-batch a file
    epochs = spark.read.parquet(f"{tmp_dir}/out").groupBy("epoch").count().collect()
    assert len(epochs) >= 4                                   # earlier epochs stay readable
    assert _rows(streaming.read_table(spark, f"{tmp_dir}/out"), "VendorID") == \
        _rows(Q.night_trips_per_vendor(trips), "VendorID")


def test_stream_takes_any_zone_table(spark, tmp_dir):
    """No bound on the zones: the result is that of the batch form, broadcast or not."""
    trips, zones = fixtures.trips(spark, SF_SMALL), fixtures.zones(spark, SF_SMALL)
    files.write_parquet(trips, f"{tmp_dir}/src")
    session = streaming.stream_session(spark, 3)
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    stream = streaming.trip_stream(session, f"{tmp_dir}/src")
    streaming.run_to_table(streaming.revenue_stream(stream, fixtures.zones(session, SF_SMALL)), f"{tmp_dir}/out")
    assert _rows(streaming.read_table(spark, f"{tmp_dir}/out"), "Borough") == \
        _rows(Q.revenue_by_borough(trips, zones), "Borough")
