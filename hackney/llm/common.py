"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import hackney
from hackney.session import scratch_path, table_path

_SHIPPED: set[str] = set()  # applications whose workers have the package


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the driver's, for a query that runs on Python workers too."""
    ship_package(spark)
    return spark.read.parquet(table_path(sf_dir, name))


def materialise(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once under the shared checkpoint folder and read back.

    Cuts the lineage with files every executor can read, so a lost executor
    costs a re-read and never a recomputation of what came before.
    """
    path = scratch_path(df.sparkSession, "llm", label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_sample(rows: DataFrame, keys: list[str], value_col: str, size: int, group_col: str | None = None) -> DataFrame:
    """At most ``size`` rows (group, value) a group: the distinct ``keys`` of the least hashes.

    Rows equal in group and ``keys`` count once, so repeated ids or rows neither
    fill nor empty the sample; rows with a NULL group or value take no part. A first
    pass shuffles hashes alone, of which a task sends ``size`` a group on to the
    ranking; one number a group reaches the driver. Values are shuffled for the
    sample only.
    """
    group = F.col(group_col).cast("string") if group_col else F.lit("")
    rows = rows.where(F.col(value_col).isNotNull()).select(
        group.alias("group"), F.col(value_col).alias("value"), F.xxhash64(F.lit("sample"), *keys).alias("place"))
    rows = rows.where(F.col("group").isNotNull())
    order = Window.partitionBy("group").orderBy("place")
    ends = {r["group"]: r["end"] for r in rows.select("group", "place").distinct()
            .withColumn("n", F.row_number().over(order)).where(F.col("n") <= size)
            .groupBy("group").agg(F.max("place").alias("end")).collect()}
    if not ends:
        return rows.select("group", "value").limit(0)
    end = F.create_map(*[F.lit(x) for pair in sorted(ends.items()) for x in pair])
    return (rows.where(F.col("place") <= F.element_at(end, F.col("group")))
            .groupBy("group", "place").agg(F.min("value").alias("value")).select("group", "value"))


def ship_package(spark: SparkSession) -> None:
    """Let the Python workers of ``spark`` import this package.

    A job submitted with ``--py-files``, a ``PYTHONPATH`` that names the
    package's folder or a start from there needs nothing; else the package is
    sent to the workers as a zip file, once a session.
    """
    root = Path(hackney.__file__).resolve().parent.parent
    known = {Path(p).resolve() for p in [*os.environ.get("PYTHONPATH", "").split(os.pathsep), os.getcwd()]}
    context = spark.sparkContext
    if not root.is_dir() or root in known or context.applicationId in _SHIPPED:
        return
    # The driver serves this file to the workers as long as the session lasts.
    folder = tempfile.mkdtemp(prefix="hackney-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = Path(folder, "hackney.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted((root / "hackney").rglob("*.py")):
            out.write(path, path.relative_to(root))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)
