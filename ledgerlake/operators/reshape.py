"""Reshaping: unpivot, row-has-data test, union by name (PRJ-05, FLT-04, UN-01, DQ-16)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlake.functions._util import col


def require_columns(df: DataFrame, expected: Sequence[str], what: str) -> None:
    """Fail when any expected column is absent (a schema check, no job)."""
    missing = [c for c in expected if c not in df.columns]
    if missing:
        raise ValueError(f"Missing expected columns in {what}: {', '.join(missing)}")


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str,
            value_type: str = "double") -> DataFrame:
    """Wide -> long, one row per (id row, value column); NULL values kept."""
    cast = df.select(*ids, *[F.col(v).cast(value_type).alias(v) for v in values])
    return cast.unpivot(list(ids), list(values), name, value)


def has_data(values: Sequence) -> Column:
    """TRUE if any of the columns is neither NULL, NaN nor zero."""
    arr = F.array(*[col(v).cast("double") for v in values])
    return F.coalesce(F.exists(arr, lambda v: v.isNotNull() & ~F.isnan(v) & (v != 0)), F.lit(False))


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Bind rows by column name; columns missing in a frame become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(float(v)) + "D" if isinstance(v, float) else str(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_frame(spark, rows, columns) -> DataFrame:
    """A small fixed table (configuration, a vocabulary) as a JVM-side
    ``VALUES`` relation - no Python RDD, no Python worker, one call.

    ``columns``: sequence of ``(name, spark_type)``.
    """
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(t).alias(n) for n, t in columns])
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in row) + ")" for row in rows)
    names = ", ".join(f"c{i}" for i in range(len(columns)))
    casts = ", ".join(f"CAST(c{i} AS {t}) AS `{n}`" for i, (n, t) in enumerate(columns))
    return spark.sql(f"SELECT {casts} FROM VALUES {values} AS t({names})")
