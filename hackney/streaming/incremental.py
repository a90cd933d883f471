"""The trip aggregates over a folder where trip files keep arriving.

Trip data lands as files (one per month in the reference's world). A file
source stream picks up only new files on each trigger; the aggregation state
(one row per vendor or borough) lives in the checkpoint, so a restarted query
continues where it stopped and never counts a file twice.

* The zone lookup is a stream-static join; then a single aggregation follows
  (the batch plan's aggregate before the join would chain two aggregations,
  which a complete-mode stream does not allow). Whether the zones are
  broadcast is the optimiser's choice, as in the batch form.
* Each epoch's result (bounded by vendors/boroughs) becomes one file in a
  folder of its own, which appears by a rename; readers take the last epoch and
  so never see an empty or half-written table. Not the memory sink, which is
  not fault-tolerant.
* A stream runs in a session of its own (``stream_session``), so the number of
  state partitions is set without touching the caller's settings.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hackney.plans.queries import night_trip_counts, revenue_sums_once
from hackney.schemas import TIMESTAMP_FORMAT, TRIPS
from hackney.session import scratch_path
from hackney.sources import files


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session for streams. ``state_partitions`` sets the number of state-store
    partitions of their aggregations (fixed in the checkpoint at the first
    start; AQE does not resize stateful streams). Partial aggregates are
    combined before the shuffle, so a state bounded by vendors/boroughs needs
    only a few.
    """
    session = spark.newSession()
    if state_partitions is not None:
        session.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    return session


def trip_stream(spark: SparkSession, path: str, schema: T.StructType = TRIPS,
                fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming DataFrame over the files of ``path`` (Parquet or header-led CSV)."""
    in_file = schema
    if fmt == "csv":
        # Resolve columns by header name, as the batch reader does; an empty
        # folder (files yet to arrive) falls back to the declared order.
        try:
            header = files.csv_header(spark, path)
        except AnalysisException:  # nothing to read a header from yet
            header = schema.fieldNames()
        in_file = files.file_schema(header, schema)
    reader = spark.readStream.schema(in_file).format(fmt)
    if fmt == "csv":
        reader = reader.options(header="true", enforceSchema="false",
                                timestampNTZFormat=TIMESTAMP_FORMAT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return files.conform(reader.load(path), schema)


def night_trips_stream(trips: DataFrame) -> DataFrame:
    """Q4's aggregate, unordered (streams sort only on read)."""
    return night_trip_counts(trips)


def revenue_stream(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Q6's eight sums per pick-up borough as one streaming aggregation."""
    return revenue_sums_once(trips, zones)


def run_to_table(result: DataFrame, table_path: str, checkpoint: str | None = None,
                 available_now: bool = True):
    """Run a streaming aggregate in complete mode into a table of epochs.

    With ``available_now`` the query processes every file present, in as many
    micro-batches as the source options allow, then stops; otherwise it keeps
    running and the caller owns the returned ``StreamingQuery``.
    """
    def write_epoch(batch: DataFrame, epoch_id: int) -> None:
        # One file: it appears in the folder by a single rename.
        batch.coalesce(1).write.mode("overwrite").parquet(f"{table_path}/epoch={epoch_id}")

    writer = (result.writeStream.outputMode("complete").foreachBatch(write_epoch)
              .option("checkpointLocation", checkpoint or scratch_path(result.sparkSession, "streams")))
    writer = writer.trigger(availableNow=True) if available_now else writer
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query


def read_table(spark: SparkSession, table_path: str) -> DataFrame:
    """The result of the last finished epoch."""
    epochs = spark.read.parquet(table_path)
    last = epochs.agg(F.max("epoch")).first()[0]
    return epochs.where(F.col("epoch") == last).drop("epoch")
