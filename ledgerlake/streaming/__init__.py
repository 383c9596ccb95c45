"""Incremental ingest of landed cell grids with Structured Streaming.

The source system refreshes whole batches; the only incremental behaviour it
has is that new monthly sheets land over time. :func:`ingest_new_sheets`
picks up newly landed cell files with a file-source stream and appends the
resolved long facts, using ``trigger(availableNow=True)`` so a scheduled run
processes what has landed and stops. No state beyond the file log is kept.
"""

from ledgerlake.streaming.ingest import ingest_new_sheets

__all__ = ["ingest_new_sheets"]
