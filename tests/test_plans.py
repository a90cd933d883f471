"""Physical-plan shape: what must (and must not) appear at scale."""

from __future__ import annotations

import contextlib
import io

import pytest

from hackney.plans import queries as Q
from hackney.plans.registry import QUERIES
from hackney.sources import files, fixtures
from tests.conftest import SF_SMALL

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas",
                "FlatMapGroupsInPandas")


def physical(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def final_plan(df) -> str:
    """Plan after AQE finished (runs the query)."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", list(QUERIES))
def test_no_python_in_query_plans(spark, key):
    plan = physical(QUERIES[key](spark, SF_SMALL))
    assert not any(node in plan for node in PYTHON_NODES), plan


@pytest.mark.parametrize("key", ["q3_same_borough_trips", "q5_top_zone_pairs",
                                 "q5_top_zone_pairs_by_id", "q6_revenue_by_borough",
                                 "q6_revenue_by_borough_unknown"])
def test_zone_lookups_are_broadcast(spark, key):
    plan = final_plan(QUERIES[key](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan


@pytest.mark.parametrize("key", ["q5_top_zone_pairs", "q5_top_zone_pairs_by_id"])
def test_top_k_is_take_ordered(spark, key):
    assert "TakeOrderedAndProject" in physical(QUERIES[key](spark, SF_SMALL))


@pytest.mark.parametrize("key", ["q1_hourly_mean_pickup", "q3_same_borough_trips",
                                 "q4_night_trips_per_vendor", "q6_revenue_by_borough"])
def test_aggregates_combine_map_side(spark, key):
    plan = physical(QUERIES[key](spark, SF_SMALL))
    assert "partial_" in plan


@pytest.fixture(scope="module")
def trips_parquet(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("trips") / "pq")
    files.write_parquet(fixtures.trips(spark, SF_SMALL), path)
    return path


def test_q1_prunes_columns_and_pushes_filters(spark, trips_parquet):
    plan = physical(Q.hourly_mean_pickup(files.read_parquet(spark, trips_parquet)))
    read_schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert read_schema == ("struct<tpep_pickup_datetime:timestamp_ntz,"
                           "pickup_longitude:double,pickup_latitude:double>")
    pushed = plan.split("PushedFilters: ")[1].split("\n")[0]
    assert "Not(EqualTo(pickup_longitude,0.0))" in pushed
    assert "Not(EqualTo(pickup_latitude,0.0))" in pushed


def test_q4_reads_two_columns(spark, trips_parquet):
    plan = physical(Q.night_trips_per_vendor(files.read_parquet(spark, trips_parquet)))
    assert "ReadSchema: struct<VendorID:int,tpep_pickup_datetime:timestamp_ntz>" in plan


def test_q6_reads_only_revenue_columns(spark, trips_parquet):
    trips = files.read_parquet(spark, trips_parquet)
    plan = physical(Q.revenue_by_borough(trips, fixtures.zones(spark, SF_SMALL)))
    for unused in ("pickup_longitude", "tpep_pickup_datetime", "DOLocationID", "VendorID"):
        assert unused not in plan.split("ReadSchema: ")[1].split("\n")[0]


@pytest.mark.parametrize("key, ids", [("q3_same_borough_trips", "PULocationID, DOLocationID"),
                                      ("q5_top_zone_pairs", "PULocationID, DOLocationID"),
                                      ("q6_revenue_by_borough", "PULocationID")])
@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_trips_meet_zones_as_finished_sums(spark, key, ids, threshold):
    """No lookup below the partial aggregate on ids, whether the zones are broadcast or not."""
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        plan = QUERIES[key](spark, SF_SMALL)._jdf.queryExecution().sparkPlan().toString()
        lines = plan.split("\n")
        at = next(i for i, line in enumerate(lines) if "lineitem.parquet" in line)  # trips' scan
        indent = len(lines[at]) - len(lines[at].lstrip(" :+-"))
        above = []                                       # from the scan up to the root
        for line in reversed(lines[:at]):
            depth = len(line) - len(line.lstrip(" :+-"))
            if depth < indent:
                above.append(line.lstrip(" :+-"))
                indent = depth
        names = [line.split("(")[0].split(" ")[0] for line in above]
        assert "HashAggregate" in names[:names.index(next(n for n in names if n.endswith("Join")))]
        first = next(line for line in above if line.startswith("HashAggregate"))
        keys = first.split("keys=[")[1].split("]")[0]
        assert [k.split("#")[0].strip() for k in keys.split(",")] == ids.split(", ")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


@pytest.mark.parametrize("key", [k for k in QUERIES if not k.endswith(("_csv", "_raw", "_stream"))
                                 and k not in ("c0_csv_to_parquet", "ingest_raw_trips")])
def test_building_a_parquet_query_runs_no_job(spark, key):
    """Nothing is written or checked before the action."""
    fixtures.trips(spark, SF_SMALL), fixtures.zones(spark, SF_SMALL)     # the footers' schema job
    group = f"build-{key}"
    spark.sparkContext.setJobGroup(group, key)
    QUERIES[key](spark, SF_SMALL)
    stages = [spark.sparkContext.statusTracker().getJobInfo(j) for j in
              spark.sparkContext.statusTracker().getJobIdsForGroup(group)]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # At most a footer read for each of the three tables' schemas.
    assert len(stages) <= 3 and all(len(s.stageIds) == 1 for s in stages if s)


def test_raw_parse_splits_each_line_a_bounded_number_of_times(spark, tmp_path):
    from hackney.plans.raw import RAW_VARIANTS
    from hackney.schemas import TRIPS
    from hackney.sources import rawtext
    path = fixtures.write_raw_trips(spark, SF_SMALL, str(tmp_path / "raw"))
    columns = RAW_VARIANTS["q6_revenue_by_borough_raw"][1]
    plan = physical(rawtext.ingest(spark, path, TRIPS, columns=columns, drop_malformed=["airport_fee"],
                                  optional=["airport_fee"]))
    # arity filter, malformed fee, projection: not one per field
    assert plan.split("== Physical Plan ==")[1].count("split(") <= 6
    assert "zip_with" not in plan and "exists(" not in plan


@pytest.mark.parametrize("key", list(QUERIES))
def test_no_query_shuffles_trips_into_a_join(spark, key):
    plan = final_plan(QUERIES[key](spark, SF_SMALL))
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan, plan
