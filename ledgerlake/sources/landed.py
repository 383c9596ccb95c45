"""Landed tables (SRC-01, SRC-07, SRC-08, SNK-01) and versioned bundles of
tables (SNK-02)."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ledgerlake.functions.text import tidy_columns

READ_FORMATS = ("parquet", "csv", "json", "orc")


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None,
               tidy: bool = False, **options) -> DataFrame:
    """Read a landed table by declared format (allow-list); optionally tidy
    the header names. CSV/JSON should pass an explicit schema so no
    inference pass over the data is needed."""
    if fmt not in READ_FORMATS:
        raise ValueError(f"Unsupported dataset format '{fmt}'.")
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        options.setdefault("header", "true")
    df = reader.options(**options).load(path)
    return tidy_columns(df) if tidy else df


def stage_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by=None) -> str:
    """Write next to ``path``; the table there stays as it is."""
    staged = f"{path.rstrip('/')}.staged-{uuid.uuid4().hex[:12]}"
    w = df.write.mode("error").format(fmt)
    try:
        (w.partitionBy(*partition_by) if partition_by else w).save(staged)
    except Exception:
        drop_table(df.sparkSession, staged)
        raise
    return staged


def drop_table(spark: SparkSession, path: str) -> None:
    fs, folder = _folder(spark, path)
    fs.delete(folder, True)


def publish_table(spark: SparkSession, staged: str, path: str) -> None:
    """Put a staged table in the place of ``path`` by renaming folders."""
    fs, new = _folder(spark, staged)
    _, place = _folder(spark, path)
    _, old = _folder(spark, f"{staged}.old")
    had = fs.exists(place)
    if had and not fs.rename(place, old):
        raise OSError(f"cannot set aside {path}")
    if not fs.rename(new, place):
        if had:
            fs.rename(old, place)
        raise OSError(f"cannot publish {staged} as {path}")
    if had:
        fs.delete(old, True)


def _folder(spark: SparkSession, path: str):
    """(file system, path) of a folder on any store that Spark writes to."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by=None) -> None:
    """Overwrite sink of one table; partitions by ``year`` when asked (SNK-01).
    The new table is written in full before it replaces the old one, so a job
    that fails - a guard, a lost cluster - leaves the old table as it was. The
    replacement is two renames; a driver lost between them leaves the old table
    as ``<path>.staged-*.old``. Tables that must change together, or under
    readers, belong in a bundle (:func:`commit_version`)."""
    publish_table(df.sparkSession, stage_table(df, path, fmt, partition_by), path)


# --- versioned bundles ---------------------------------------------------------
# <root>/versions/<version>/<table>/...   written once, never changed
# <root>/_commits/<number>.<version>      an empty file; the highest one is current

def new_version(root: str) -> tuple[str, str]:
    """(version, folder) of a bundle that is about to be written."""
    version = f"{time.strftime('%Y%m%dT%H%M%S', time.gmtime())}-{uuid.uuid4().hex[:12]}"
    return version, f"{root.rstrip('/')}/versions/{version}"


def commits(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """(number, version) of all commits, oldest first."""
    fs, folder = _folder(spark, f"{root.rstrip('/')}/_commits")
    if not fs.exists(folder):
        return []
    names = [f.getPath().getName().partition(".") for f in fs.listStatus(folder)]
    return sorted((int(number), version) for number, _, version in names if number.isdigit() and version)


def commit_version(spark: SparkSession, root: str, version: str) -> None:
    """Make a fully written version the current one. The commit is the creation
    of one empty file: it exists or it does not, on any store, and no table of
    an earlier version is touched. Of two writers with the same number the one
    whose version sorts last is current, for every reader."""
    number = max((n for n, _ in commits(spark, root)), default=0) + 1
    fs, marker = _folder(spark, f"{root.rstrip('/')}/_commits/{number:012d}.{version}")
    fs.create(marker, False).close()


def current_version(spark: SparkSession, root: str) -> str:
    """Folder of the current version."""
    done = commits(spark, root)
    if not done:
        raise FileNotFoundError(f"No committed version: {root}")
    return f"{root.rstrip('/')}/versions/{done[-1][1]}"


def drop_versions(spark: SparkSession, root: str, keep: int = 2, abandoned_hours: float = 24.0) -> list[str]:
    """Delete versions older than the last ``keep`` commits, and those without
    a commit that nobody has changed for ``abandoned_hours``. Readers that hold
    a path of a kept version go on reading it."""
    done = commits(spark, root)
    kept, known = {v for _, v in done[-max(keep, 1):]}, {v for _, v in done}
    fs, folder = _folder(spark, f"{root.rstrip('/')}/versions")
    gone = []
    for status in fs.listStatus(folder) if fs.exists(folder) else []:
        version, age = status.getPath().getName(), time.time() - status.getModificationTime() / 1000
        if version not in kept and (version in known or age > abandoned_hours * 3600):
            fs.delete(status.getPath(), True)
            gone.append(version)
    return gone
