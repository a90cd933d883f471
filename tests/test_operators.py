"""Relational operators on literal rows: lookups, arg-max, ordered first, top-k."""

from __future__ import annotations

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from hackney.functions import with_order_key
from hackney.functions.ordering import LOW
from hackney.operators import arg_max, arg_max_packed, first_packed, lookup_join, ordered_first, top_k
from tests.conftest import make_zones


@pytest.fixture
def zones(spark):
    return make_zones(spark, [(1, "Manhattan", "Midtown"), (2, "Queens", "JFK"),
                              (3, "Queens", "Astoria"), (4, "Queens", "Astoria")])


def test_lookup_left_inner_default(spark, zones):
    facts = spark.createDataFrame([(1,), (2,), (9,), (None,)], "id int")
    left = lookup_join(facts, zones, "id", "LocationID", {"Borough": "B"})
    assert sorted(left.collect(), key=str) == sorted(
        [(1, "Manhattan"), (2, "Queens"), (9, None), (None, None)], key=str)
    inner = lookup_join(facts, zones, "id", "LocationID", {"Borough": "B"}, how="inner")
    assert sorted(r.id for r in inner.collect()) == [1, 2]
    dflt = lookup_join(facts, zones, "id", "LocationID", {"Borough": "B"}, default="Unknown")
    assert sorted(r.B for r in dflt.collect()) == ["Manhattan", "Queens", "Unknown", "Unknown"]


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_duplicate_keys_are_an_error_however_the_join_runs(spark, threshold):
    dup = make_zones(spark, [(1, "A", "a"), (1, "B", "b"), (2, "C", "c"), (None, "D", "d"), (None, "E", "e")])
    facts = spark.createDataFrame([(1,), (2,)], "id int")
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        with pytest.raises(Exception, match="lookup key 'LocationID' is not unique: 1"):
            lookup_join(facts, dup, "id", "LocationID", {"Borough": "B"}).collect()
        unique = dup.where("LocationID = 2 OR LocationID IS NULL")   # NULL keys never match
        got = lookup_join(facts, unique, "id", "LocationID", {"Borough": "B"}).collect()
        assert sorted((r.id, r.B) for r in got) == [(1, None), (2, "C")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_building_a_lookup_runs_no_job(spark, zones):
    facts = spark.createDataFrame([(1,), (2,)], "id int")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lookup-build", "none expected")
    plan = lookup_join(facts, zones, "id", "LocationID", {"Borough": "B"})
    assert not tracker.getJobIdsForGroup("lookup-build")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GlobalLimit" not in text and "partial_count" in text


def test_same_dimension_in_two_roles(spark, zones):
    facts = spark.createDataFrame([(1, 2), (3, 4)], "pu int, do int")
    j = lookup_join(facts, zones, "pu", "LocationID", {"Zone": "PZ"})
    j = lookup_join(j, zones, "do", "LocationID", {"Zone": "DZ"})
    assert sorted((r.PZ, r.DZ) for r in j.collect()) == [("Astoria", "Astoria"), ("Midtown", "JFK")]


def test_arg_max_tie_prefers_longer_duration(spark):
    df = spark.createDataFrame([(1, 5.0, 10.0), (1, 5.0, 12.0), (1, 4.0, 99.0), (2, 1.0, 3.0)],
                               "k int, dist double, dur double")
    out = arg_max(df, ["k"], ["dist", "dur"], {"d": "dist", "m": "dur"})
    assert sorted(out.collect()) == [(1, 5.0, 12.0), (2, 1.0, 3.0)]


def test_arg_max_skewed_key_many_partitions(spark):
    # One key holds most rows; the partial aggregate must still be exact.
    df = spark.range(0, 20000, numPartitions=16).select(
        F.when(F.col("id") % 3 == 0, F.lit(2)).otherwise(F.lit(1)).alias("k"),
        (F.col("id") % 997).cast("double").alias("v"), F.col("id").cast("double").alias("w"))
    out = dict((r.k, r.w) for r in arg_max(df, ["k"], ["v", "w"], {"w": "w"}).collect())
    assert out[1] == max(i for i in range(20000) if i % 3 != 0 and i % 997 == 996)
    assert out[2] == max(i for i in range(20000) if i % 3 == 0 and i % 997 == 996)


def test_ordered_first(spark):
    df = spark.createDataFrame([(1, 3, 30.0), (1, 1, 10.0), (1, 1, 5.0), (1, None, 1.0)],
                               "k int, t int, v double")
    out = df.groupBy("k").agg(ordered_first("v", ["t", "v"]).alias("f")).first()
    assert out.f == 5.0


def test_top_k_total_order(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 7), ("d", 1)], "name string, n int")
    out = top_k(df, 2, "-n", "name").collect()
    assert [(r.name, r.n) for r in out] == [("c", 7), ("a", 5)]
    plan = top_k(df, 2, "-n", "name")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_sort_small_orders_in_one_partition(spark):
    from hackney.operators import sort_small
    df = spark.createDataFrame([("b", 5), (None, 5), ("a", 5), ("c", 9)], "k string, n int")
    out = sort_small(df.repartition(3), "-n", "k")
    assert [tuple(r) for r in out.collect()] == [("c", 9), ("a", 5), ("b", 5), (None, 5)]
    assert out.rdd.getNumPartitions() == 1


def _doubles():
    r = random.Random(4)
    edges = [2.0 ** e for e in range(-1074, 1024, 7)] + [2.0 ** e for e in range(-5, 60)] + [5e-324, 2.0 ** -1022, 1.7976931348623157e308]
    near = [math.nextafter(x, to) for x in edges for to in (0.0, math.inf)]
    some = [struct.unpack("d", r.randbytes(8))[0] for _ in range(3000)] + [r.uniform(0, 20016) for _ in range(1000)]
    values = [x for x in [*edges, *near, *some, 0.0, math.inf] if not math.isnan(x)]
    return [*values, *[-x for x in values], math.nan]


def test_order_keys_order_as_doubles_do(spark):
    values = _doubles()
    df = spark.createDataFrame([(None,), *[(x,) for x in values]], "x double")
    rows = with_order_key(df, "x", "key").collect()
    known = sorted((r.x, r.key) for r in rows if r.x is not None and not math.isnan(r.x))
    assert all((a[0] == b[0]) == (a[1] == b[1]) and a[1] <= b[1] for a, b in zip(known, known[1:]))
    null, nan = ({r.key for r in rows if r.x is None}, {r.key for r in rows if r.x is not None and math.isnan(r.x)})
    assert null == {-(2 ** 63 - 1)} and nan == {2 ** 63 - 1}
    assert -(2 ** 63 - 1) < known[0][1] and known[-1][1] < 2 ** 63 - 1
    for x, key in known:  # the binary64 bits themselves
        assert key == int(math.copysign(1, x)) * struct.unpack("q", struct.pack("d", abs(x)))[0]


def test_packed_arg_max_equals_the_struct_form(spark):
    r = random.Random(5)
    values = [None, math.nan, math.inf, -math.inf, 0.0, -0.0, 1.5, math.nextafter(1.5, 2), 20000.25, -3.0]
    rows = [(k, r.choice(values[:n]), r.choice([None, 0, -7, 5, 5, LOW - 1, 1 - LOW]))
            for n in (1, 2, 3, 4, 6, 10) for k in range(100 * n, 100 * n + 30) for _ in range(r.randint(1, 6))]
    df = spark.createDataFrame(rows, "k int, v double, s bigint")
    show = lambda rows: sorted((x.k, repr(x.v if x.v is None else x.v + 0.0), x.s) for x in rows)
    packed = arg_max_packed(df, ["k"], "v", "s").collect()
    # 0.0 and -0.0 are one value; which of them is shown is left open.
    assert show(packed) == show(arg_max(df, ["k"], ["v", "s"], {"v": "v", "s": "s"}).collect())
    with pytest.raises(Exception, match="too large for a packed order"):
        arg_max_packed(spark.createDataFrame([(1, 1.0, LOW)], "k int, v double, s bigint"), ["k"], "v", "s").collect()


def test_packed_first_equals_the_ordered_first(spark):
    r = random.Random(6)
    times = [None, "0001-01-01 00:00:00", "1969-12-31 23:59:59.999999", "2024-01-01 10:00:00", "9999-12-31 23:59:59"]
    rows = [(k, r.choice(times), r.choice([None, -5, 0, 60, 61])) for k in range(60) for _ in range(r.randint(1, 5))]
    df = spark.createDataFrame(rows, "k int, t string, s bigint").withColumn("t", F.col("t").cast("timestamp_ntz"))
    got = df.groupBy("k").agg(first_packed("s", "t").alias("a"), ordered_first("s", ["t", "s"]).alias("b")).collect()
    assert [x.a for x in got] == [x.b for x in got] and len({x.a for x in got}) > 3
