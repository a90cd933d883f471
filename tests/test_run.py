"""The command-line runner over Parquet, CSV and raw text trip files."""

from __future__ import annotations

import pytest

from hackney import run
from hackney.plans import queries as Q
from hackney.schemas import TRIPS
from hackney.sources import files, fixtures
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("run")
    trips, zones = fixtures.trips(spark, SF_SMALL), fixtures.zones(spark, SF_SMALL)
    files.write_parquet(trips, f"{base}/pq")
    files.write_csv(trips.repartition(2), f"{base}/csv")
    files.write_csv(zones.coalesce(1), f"{base}/zones")
    return base, trips, zones


@pytest.mark.parametrize("fmt", ["parquet", "csv", "text"])
def test_runner_formats_agree(spark, inputs, fmt, capsys):
    base, trips, zones = inputs
    path = f"{base}/pq" if fmt == "parquet" else f"{base}/csv"
    out = run.main(["q6_revenue_by_borough", "--trips", path, "--trips-format", fmt,
                    "--zones", f"{base}/zones"])
    assert out.collect() == Q.revenue_by_borough(trips, zones).collect()
    assert "q6_revenue_by_borough:" in capsys.readouterr().out


def test_runner_writes_output(spark, inputs, tmp_dir):
    base, trips, _ = inputs
    run.main(["q4_night_trips_per_vendor", "--trips", f"{base}/pq", "--output", f"{tmp_dir}/o"])
    got = sorted(tuple(r) for r in files.read_parquet(spark, f"{tmp_dir}/o").collect())
    assert got == sorted(tuple(r) for r in Q.night_trips_per_vendor(trips).collect())


def test_runner_requires_zones(spark, inputs):
    base, _, _ = inputs
    with pytest.raises(SystemExit):
        run.main(["q3_same_borough_trips", "--trips", f"{base}/pq"])


def test_runner_explain(spark, inputs, capsys):
    base, _, _ = inputs
    run.main(["q1_hourly_mean_pickup", "--trips", f"{base}/pq", "--explain", "--show", "3"])
    out = capsys.readouterr().out
    assert "== Physical Plan ==" in out and "PushedFilters" in out


def test_runner_text_of_another_layout(spark, tmp_dir, capsys):
    """A zone-layout text file: extra columns, 'Airport_fee', no coordinates."""
    import os
    os.makedirs(f"{tmp_dir}/t")
    with open(f"{tmp_dir}/t/part-0.csv", "w") as fh:
        fh.write("VendorID,tpep_pickup_datetime,passenger_count,PULocationID,fare_amount,"
                 "Airport_fee\n")
        fh.write("2,2024-01-01 23:30:00,1,132,70.0,1.75\n")
        fh.write("1,2024-01-01 12:00:00,2,161,10.5,\n")
        fh.write("2,2024-01-02 03:05:00,1,132,52.0,1.75\n")
    night = run.main(["q4_night_trips_per_vendor", "--trips", f"{tmp_dir}/t",
                      "--trips-format", "text"])
    assert [tuple(r) for r in night.collect()] == [(2, 2)]
    trips = run.read_trips(spark, f"{tmp_dir}/t", "text", "q6_revenue_by_borough")
    fees = sorted((r.airport_fee is None, r.airport_fee) for r in trips.collect())
    assert fees == [(False, 1.75), (False, 1.75), (True, None)]
    located = run.read_trips(spark, f"{tmp_dir}/t", "text", "q1_hourly_mean_pickup")
    assert located.where("pickup_longitude IS NOT NULL").count() == 0


def test_runner_equals_the_registered_text_queries(spark, capsys):
    """One text path: the runner and the registry give the same on the fixture with bad fields."""
    from hackney.plans import registry
    from hackney.plans.raw import RAW_VARIANTS
    zones = registry.zones_csv(spark, SF_SMALL)
    text = registry.raw_trips_text(spark, SF_SMALL)
    for key, (base, _) in RAW_VARIANTS.items():
        got = run.main([base, "--trips", text, "--trips-format", "text", "--zones", zones]).collect()
        assert got == registry.QUERIES[key](spark, SF_SMALL).collect(), key


def test_runner_strict_and_options(spark, tmp_dir, capsys):
    import os
    os.makedirs(f"{tmp_dir}/t")
    with open(f"{tmp_dir}/t/part-0.csv", "w") as fh:
        fh.write("VendorID,tpep_pickup_datetime,pickup_longitude,pickup_latitude\n"
                 "1,2024-01-01 23:30:00,-73.9,40.7\n2,2024-1-2 1:0:0,-73.5,40.5\n1,bad,-73.1,40.1\nx,2024-01-01 23:00:00,-73.0,40.0\n")
    args = ["--trips", f"{tmp_dir}/t", "--trips-format", "text"]
    night = {r.VendorID: r.NightTripsCount for r in run.main(["q4_night_trips_per_vendor", *args]).collect()}
    assert night == {1: 1, 2: 1, None: 1}
    night = {r.VendorID: r.NightTripsCount for r in run.main(["q4_night_trips_per_vendor", *args, "--strict"]).collect()}
    assert night == {1: 1, 2: 1}
    hours = [r.hour for r in run.main(["q1_hourly_mean_pickup", *args, "--keep-null-hour"]).collect()]
    assert hours == [1, 23, None]
    assert [r.hour for r in run.main(["q1_hourly_mean_pickup", *args]).collect()] == [1, 23]
    capsys.readouterr()
    run.main(["q1_hourly_mean_pickup", *args, "--show", "1"])
    assert "only the first 1 rows" in capsys.readouterr().out


def test_runner_converts_folders(spark, inputs, tmp_dir, capsys):
    base, trips, _ = inputs
    run.main(["convert", f"{base}/csv={tmp_dir}/trips", f"{base}/zones={tmp_dir}/zones"])
    back = files.read_parquet(spark, f"{tmp_dir}/trips")
    assert back.schema == TRIPS and back.exceptAll(trips).count() == 0
    assert files.read_parquet(spark, f"{tmp_dir}/zones").count() == 25
    with pytest.raises(SystemExit):
        run.main(["convert", "no-target"])
