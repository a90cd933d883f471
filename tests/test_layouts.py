"""Folders of files with different layouts, quoted text, other stores."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hackney.functions import preview, report
from hackney.schemas import TRIPS
from hackney.sources import files, fixtures, layouts, rawtext
from tests.conftest import SF_SMALL

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("day", T.TimestampNTZType()),
                       T.StructField("fee", T.DoubleType()), T.StructField("name", T.StringType())])


def _text(path, name, lines):
    path.mkdir(exist_ok=True)
    (path / name).write_text("".join(f"{x}\n" for x in lines))


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def folder(tmp_path):
    path = tmp_path / "mixed"
    _text(path, "a.csv", ["id,day,fee", "1,2024-01-01 10:00:00,1.5", "2,2024-01-02 10:00:00,"])
    _text(path, "b.csv", ["NAME,Fee,other,ID", "x,2.5,o,3", "y,,o,4"])
    _text(path, "c.csv", ["id,day,fee", "5,2024-01-05 10:00:00,5.5"])
    _text(path, "empty.csv", [])
    return path


WANT = [(1, "2024-01-01 10:00:00", 1.5, None), (2, "2024-01-02 10:00:00", None, None), (3, None, 2.5, "x"),
        (4, None, None, "y"), (5, "2024-01-05 10:00:00", 5.5, None)]


def test_every_file_is_read_by_its_own_header(spark, folder):
    groups = layouts.header_groups(spark, str(folder))
    assert sorted((h, len(names)) for h, names in groups.items()) == [("NAME,Fee,other,ID", 1), ("id,day,fee", 2)]
    show = lambda df: _rows(df.withColumn("day", F.col("day").cast("string")))
    assert show(layouts.read_csv(spark, str(folder), SCHEMA)) == WANT
    text = layouts.ingest(spark, str(folder), SCHEMA)
    assert text.columns == SCHEMA.fieldNames() and show(text) == WANT
    assert show(layouts.ingest(spark, str(folder), SCHEMA, drop_malformed=True)) == WANT
    with pytest.raises(ValueError, match="no header line"):
        layouts.read_csv(spark, str(folder / "empty.csv"), SCHEMA)


def test_any_header_inside_a_file_is_no_row(spark, folder):
    _text(folder, "d.csv", ["id,day,fee", "NAME,Fee,other,ID", "6,2024-01-06 10:00:00,6", "id,day,fee"])
    assert layouts.ingest(spark, str(folder), SCHEMA).count() == 6


def test_header_lookup_stops_at_the_first_line(spark, tmp_path):
    for i in range(3):
        _text(tmp_path / "long", f"{i}.csv", ["id,day,fee", *[f"{n},,1" for n in range(200_000)]])
    read = spark.sparkContext.accumulator(0)

    def counted(rows):
        for row in layouts._first_line(rows):
            read.add(1)
            yield row

    lines = spark.read.text(str(tmp_path / "long")).select(F.col("_metadata.file_path").alias("path"), "value")
    assert len(lines.rdd.mapPartitions(counted).collect()) == lines.rdd.getNumPartitions() == read.value
    assert list(map(len, layouts.header_groups(spark, str(tmp_path / "long")).values())) == [3]


@pytest.mark.parametrize("kinds", [("INT", "INT"), ("INT", "BIGINT")])
def test_parquet_layouts_are_united(spark, tmp_path, kinds):
    path = str(tmp_path / "pq")
    spark.sql(f"SELECT CAST(1 AS {kinds[0]}) AS id, 1.5D AS fee").write.parquet(path)
    spark.sql(f"SELECT 'x' AS name, CAST(2 AS {kinds[1]}) AS id").write.mode("append").parquet(path)
    got = layouts.read_parquet(spark, path, SCHEMA)
    assert got.schema == SCHEMA and _rows(got) == [(1, None, 1.5, None), (2, None, None, "x")]


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_one_folder_equals_the_layouts_read_apart(spark, tmp_path, fmt):
    path = fixtures.write_mixed_trips(spark, SF_SMALL, str(tmp_path / "trips"), fmt, 1000)
    together = {"csv": layouts.read_csv, "parquet": layouts.read_parquet}[fmt](spark, path, TRIPS)
    keyed = fixtures.keyed_trips(spark, SF_SMALL)
    old = files.conform(keyed.where(fixtures.OLD_RULE).select(*fixtures.OLD_COLUMNS), TRIPS)
    new = files.conform(keyed.where(f"NOT ({fixtures.OLD_RULE})").select(*fixtures.NEW_COLUMNS), TRIPS)
    assert _rows(together) == _rows(old.unionByName(new))


def test_quoted_text_behaves_as_the_split_path_does(spark):
    lines = ["id,name,fee,day", '1,"a, ""b"" c",1.5,2024-01-01 10:00:00', "2,plain,x,2024-01-01 10:00:00", '3,"cut, short"',
             '4,"",,2024-01-01 10:00:00', '5,"open, 2024-01-01 10:00:00', '6,a "q, 7,2024-01-01 10:00:00',
             '"7","n","2.5","no day"', "8,n,3,2024-01-01 10:00:00,more,fields"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    parse = lambda **k: rawtext.parse_lines(df, ["id", "name", "fee", "day"], SCHEMA, quoted=True, **k)
    day = "2024-01-01 10:00:00"
    got = {r.id: (r.name, r.fee, r.day and str(r.day)) for r in parse().collect()}
    assert got == {1: ('a, "b" c', 1.5, day), 2: ("plain", None, day), 4: (None, None, day), 6: ('a "q', 7.0, day),
                   7: ("n", 2.5, None), 8: ("n", 3.0, day)}
    assert sorted(r.id for r in parse(drop_malformed=True).collect()) == [1, 4, 6, 8]
    assert sorted(r.id for r in parse(columns=["id", "name"]).collect()) == [1, 2, 3, 4, 5, 6, 7, 8]
    assert sorted(r.id for r in parse(columns=["id"], min_fields=6).collect()) == [8]
    long = spark.createDataFrame([(f'1,"{chr(34) * 200_000}",1,{day}',)], "value string")
    row = rawtext.parse_lines(long, ["id", "name", "fee", "day"], SCHEMA, quoted=True).first()
    assert len(row.name) == 100_000 and row.fee == 1.0


def test_quoted_equals_split_where_nothing_is_quoted(spark, tmp_path):
    path = fixtures.write_raw_trips(spark, SF_SMALL, str(tmp_path / "raw"))
    a, b = (rawtext.ingest(spark, path, TRIPS, optional=["airport_fee"], quoted=q) for q in (False, True))
    assert _rows(a) == _rows(b)


def test_paths_of_another_store(spark, tmp_path):
    """S8: viewfs, a Hadoop store that is neither the default nor opened by anything but Spark's readers."""
    spark.conf.set("fs.viewfs.mounttable.hackney.link./in", f"file://{tmp_path}")
    try:
        base = "viewfs://hackney/in"
        trips = fixtures.trips(spark, SF_SMALL)
        files.write_parquet(trips, f"{base}/pq")
        files.write_csv(trips, f"{base}/csv")
        files.csv_to_parquet(spark, [(f"{base}/csv", f"{base}/converted")], schemas={f"{base}/converted": TRIPS})
        fixtures.write_raw_trips(spark, SF_SMALL, f"{base}/raw")
        want = _rows(trips)
        assert _rows(files.read_parquet(spark, f"{base}/pq", TRIPS)) == want
        assert _rows(files.read_csv(spark, f"{base}/csv", TRIPS)) == want
        assert _rows(files.read_parquet(spark, f"{base}/converted")) == want
        assert _rows(layouts.read_csv(spark, f"{base}/csv", TRIPS)) == want
        assert _rows(layouts.read_parquet(spark, f"{base}/pq", TRIPS)) == want
        a = rawtext.ingest(spark, f"{base}/raw", TRIPS, optional=["airport_fee"])
        assert _rows(a) == _rows(rawtext.ingest(spark, str(tmp_path / "raw"), TRIPS, optional=["airport_fee"]))
        assert (tmp_path / "converted").is_dir()
    finally:
        spark.conf.unset("fs.viewfs.mounttable.hackney.link./in")


def test_preview_and_report(spark):
    df = spark.createDataFrame([(3, "a long label indeed", 1.005), (1, None, 2.675), (2, "b", None)], "k int, s string, v double")
    assert [r.k for r in preview(df, 2, "k").collect()] == [1, 2]
    assert [r.k for r in preview(df, 2, "-k").collect()] == [3, 2]
    assert preview(df, 0, "k").count() == 0 and preview(df, 2).count() == 2
    assert _rows(report(df, 2, 12)) == [(1, None, 2.68), (2, "b", None), (3, "a long label", 1.01)]
