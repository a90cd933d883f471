"""One folder, several file layouts: files grouped by their columns, one scan per layout.

Trip files of different years differ in columns, order, spelling
(``Airport_fee``) and types (INT and BIGINT ids). A reader that takes one
file's layout for all would shift columns or reject files. Here every file's
own header line (CSV, text) or footer (Parquet) says what it holds; files of
one layout are read by one scan, and the scans are united by column name.

The headers are read by one job of a task per file, which stops after the first
line; the driver gets a name and a header per file, as it gets the listing
itself. Parquet footers are merged by Spark; only where they cannot be (one column, two
types) is every file's schema looked up.
"""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hackney.sources import files, rawtext

#: A file is one split, and a task has one file, where this many bytes count for opening one.
_WHOLE_FILE = 2 ** 44
_LOOKUPS = 16  # footers looked up at a time


def _first_line(rows: Iterable) -> Iterable[tuple[str, str]]:
    for row in rows:
        yield row.path, row.value
        return


def header_groups(spark: SparkSession, path: str | list[str]) -> dict[str, list[str]]:
    """The files of ``path`` by header line; both in order of name. Empty files are in none."""
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", str(_WHOLE_FILE))
    session.conf.set("spark.sql.files.openCostInBytes", str(_WHOLE_FILE))
    lines = session.read.text(path).select(F.col("_metadata.file_path").alias("path"), "value")
    groups: dict[str, list[str]] = {}
    for name, header in sorted(lines.rdd.mapPartitions(_first_line).collect()):
        groups.setdefault(header, []).append(name)
    return groups


def _united(parts: list[DataFrame], path: str | list[str]) -> DataFrame:
    if not parts:
        raise ValueError(f"no header line in {path}")
    return reduce(DataFrame.unionByName, parts)


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType, mode: str = "PERMISSIVE") -> DataFrame:
    """Header-led CSV files of any layouts under one schema: columns by name, those a file lacks NULL.

    ``files.read_csv`` for each layout; see there for types and ``mode``.
    """
    return _united([files.read_csv(spark, names, schema=schema, mode=mode)
                    for names in header_groups(spark, path).values()], path)


def ingest(spark: SparkSession, path: str | list[str], schema: T.StructType, columns: list[str] | None = None,
           delimiter: str = ",", **options) -> DataFrame:
    """Text files whose headers differ, each parsed by its own (S3); options as ``rawtext.parse_lines``.

    A line that equals any of the files' headers is no row, in whichever file
    it stands. A column that a file lacks is NULL in its rows.
    """
    groups = header_groups(spark, path)
    parts = []
    for header, names in groups.items():
        lines = rawtext.read_lines(spark, names).where(~F.col("value").isin(list(groups)))
        parts.append(rawtext.parse_lines(lines, rawtext.header_names(header, delimiter), schema, columns=columns,
                                         delimiter=delimiter, absent_as_null=True, header_text=header, **options))
    return _united(parts, path)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet files of any layouts under one schema: columns by name, cast, those a file lacks NULL.

    Footers that agree on each column's type make one scan; else one per layout.
    """
    try:
        return files.conform(spark.read.option("mergeSchema", "true").parquet(path), schema)
    except (AnalysisException, Py4JJavaError) as error:
        # One column of two types, or of two spellings.
        if not any(name in str(error) for name in ("[CANNOT_MERGE_SCHEMAS]", "[COLUMN_ALREADY_EXISTS]")):
            raise
    names = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option(
        "recursiveFileLookup", "true").load(path).inputFiles()  # a listing
    with ThreadPoolExecutor(_LOOKUPS) as pool:
        layouts = pool.map(lambda name: spark.read.parquet(name).schema.json(), names)
    groups: dict[str, list[str]] = {}
    for name, layout in sorted(zip(names, layouts)):
        groups.setdefault(layout, []).append(name)
    return _united([files.conform(spark.read.parquet(*group), schema) for group in groups.values()], path)
