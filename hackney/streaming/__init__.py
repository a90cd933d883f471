"""Incremental (Structured Streaming) runs of the batch trip aggregates."""

from hackney.streaming.incremental import (night_trips_stream, read_table, revenue_stream, run_to_table,
                                           stream_session, trip_stream)

__all__ = ["night_trips_stream", "read_table", "revenue_stream", "run_to_table", "stream_session",
           "trip_stream"]
