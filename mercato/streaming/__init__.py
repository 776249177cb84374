"""Incremental ingest of the dirty case-study inputs with Structured Streaming.

The cleaning transforms are row-wise, so the batch functions of
``operators.cleaning`` are applied unchanged to streaming DataFrames; the
cleaned rows are appended to a Parquet table of the caller's choice (the
batch queries derive theirs from the source tables and don't read it). No
other streaming operator exists in the case studies (no windows, state or
late data), so none is added.
"""

from mercato.streaming.ingest import CLEANERS, RAW_SCHEMAS, clean_stream, start_clean_sink

__all__ = ["CLEANERS", "RAW_SCHEMAS", "clean_stream", "start_clean_sink"]
