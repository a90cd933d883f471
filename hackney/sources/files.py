"""CSV and Parquet files: typed reads, overwrite writes, batch conversion.

Paths are plain Hadoop-FS URIs (``hdfs://``, ``s3a://``, ``file:``, local),
always parameters. CSV is read with an explicit schema: inference costs a
full extra pass over the data before the query starts and guesses types
(timestamps come back zone-dependent); ``infer_schema=True`` remains as an
option for unknown files.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hackney.schemas import TIMESTAMP_FORMAT

_CSV_OPTIONS = {
    "header": "true",
    "timestampNTZFormat": TIMESTAMP_FORMAT,
    "timestampFormat": TIMESTAMP_FORMAT,
}


def csv_header(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Column names from the header line (Spark reads only the first line)."""
    return spark.read.options(**_CSV_OPTIONS).csv(path).columns


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None,
             infer_schema: bool = False, mode: str = "PERMISSIVE") -> DataFrame:
    """Header-led, quote-aware CSV (S1). One header line per file is skipped.

    With ``schema``, columns resolve by *name* (case-insensitively) against
    the header: the file's own column order is read with the declared types
    (undeclared columns as strings), every file's header is validated against
    it, and the result comes back in ``schema`` order. A declared column the
    file lacks (e.g. an optional fee) comes back as NULL. ``mode`` is Spark's
    malformed-record policy.
    """
    reader = spark.read.options(**_CSV_OPTIONS).option("mode", mode)
    if schema is None:
        if infer_schema:
            reader = reader.option("inferSchema", "true")
        return reader.csv(path)
    in_file = file_schema(csv_header(spark, path), schema)
    df = reader.schema(in_file).option("enforceSchema", "false").csv(path)
    return conform(df, schema)


def file_schema(header: list[str], schema: T.StructType) -> T.StructType:
    """The schema of a file with columns ``header``: declared types matched by
    name case-insensitively, undeclared columns as strings."""
    declared = {f.name.lower(): f for f in schema.fields}
    return T.StructType([
        T.StructField(name, declared[name.lower()].dataType) if name.lower() in declared
        else T.StructField(name, T.StringType())
        for name in header])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly ``schema``'s columns, matched by name case-insensitively.

    Columns are cast to the declared type (a file with INT64 vendor ids or a
    zone-layout file without coordinates reads the same); declared columns
    the input lacks come back as NULL, extra input columns are pruned.
    """
    present = {name.lower(): name for name in df.columns}
    return df.select(*[
        (F.col(present[f.name.lower()]).cast(f.dataType) if f.name.lower() in present
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite",
              max_records_per_file: int | None = None) -> str:
    """Header-led CSV, one header per part file, NULL as an empty field.

    ``max_records_per_file`` splits a task's output into several files (no
    shuffle), so later scans get more splits.
    """
    writer = df.write.mode(mode).options(**_CSV_OPTIONS)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    writer.csv(path)
    return path


def read_parquet(spark: SparkSession, path: str,
                 schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan (S5): columnar, vectorised, filters and columns pushed down.

    With ``schema`` the table is conformed to it by name (see :func:`conform`);
    the casts sit above the scan, so pruning and pushdown still apply.
    """
    df = spark.read.parquet(path)
    return conform(df, schema) if schema is not None else df


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Iterable[str] = (),
                  max_records_per_file: int | None = None) -> str:
    """Parquet sink (S6). ``partition_by`` enables partition pruning on reads;
    ``max_records_per_file`` bounds file size without a shuffle."""
    writer = df.write.mode(mode)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def csv_to_parquet(spark: SparkSession, conversions: Iterable[tuple[str, str]],
                   schemas: dict[str, T.StructType] | None = None,
                   infer_schema: bool = False,
                   partition_by: dict[str, list[str]] | None = None) -> list[str]:
    """Convert each (csv input, parquet output) pair, one distributed job each (S7).

    ``schemas`` / ``partition_by`` are keyed by output path. Overwrite mode
    makes a re-run after a failure idempotent.
    """
    schemas = schemas or {}
    partition_by = partition_by or {}
    written = []
    for source, target in conversions:
        df = read_csv(spark, source, schema=schemas.get(target), infer_schema=infer_schema)
        written.append(write_parquet(df, target, partition_by=partition_by.get(target, ())))
    return written


def records_per_file(spark: SparkSession, rows: int, min_records: int = 50_000,
                     max_records: int = 4_000_000) -> int:
    """A file size (in rows) that spreads ``rows`` over about one file per core.

    Bounded below so small tables do not shatter into tiny files and above
    (~150 MB of Parquet trips) so large ones stay splittable — with no
    repartition, at any scale each input split writes its own files.
    """
    per_core = -(-rows // max(1, spark.sparkContext.defaultParallelism))
    return max(min_records, min(max_records, per_core))
