"""ledgerlake: Spark DataFrame operators for entity-by-period fact tables.

Sub-packages
------------
functions  column builders (names, text, dates, numbers, lookups, display)
operators  DataFrame -> DataFrame building blocks (joins, aggregates, windows,
           classification, periods, monetary measures, data quality)
sources    landed tables, sparse cell grids and the dataset contract
plans      composite jobs: account series, cash balance, dashboard views,
           the artifact job and the driver-table queries
streaming  incremental ingest of landed cell grids (Structured Streaming)
"""

from ledgerlake.session import checkpoint_root, get_session, scratch_path

__all__ = ["get_session", "checkpoint_root", "scratch_path"]
