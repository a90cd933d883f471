"""Sources and sinks: driver tables, trip/zone views, CSV/Parquet files, raw text."""
