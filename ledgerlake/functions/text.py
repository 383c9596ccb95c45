"""String columns and column names (PRJ-01, PRJ-13, PRJ-14, DQ-07)."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlake.config import CANONICAL_LABELS
from ledgerlake.functions._util import col


def tidy_name(name: str) -> str:
    """camelCase -> snake, lower case, runs of other characters -> ``_``,
    one edge ``_`` stripped at each end."""
    out = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name)
    out = out.lower()
    out = re.sub(r"[^a-z0-9]+", "_", out)
    return re.sub(r"^_|_$", "", out)


def tidy_columns(df: DataFrame) -> DataFrame:
    """Rename every column with :func:`tidy_name` (metadata only, no job)."""
    return df.toDF(*[tidy_name(c) for c in df.columns])


def squish(c, null_as_empty: bool = False) -> Column:
    """Collapse whitespace runs to one space and trim; optionally NULL -> ''."""
    x = col(c)
    if null_as_empty:
        x = F.coalesce(x, F.lit(""))
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def canonical_label(c, canonical: Mapping[str, str] = CANONICAL_LABELS) -> Column:
    """Squish, then replace case-insensitive matches by their canonical spelling.

    For a large synonym list join a synonym table instead
    (:func:`ledgerlake.operators.joins.canonicalize_by_table`).
    """
    x = squish(c)
    out = None
    for key, value in canonical.items():
        cond = F.lower(x) == F.lit(key.lower())
        out = F.when(cond, F.lit(value)) if out is None else out.when(cond, F.lit(value))
    return x if out is None else out.otherwise(x)


def blank(c) -> Column:
    """TRUE where the value is NULL or only whitespace."""
    x = col(c)
    return x.isNull() | (F.trim(x.cast("string")) == F.lit(""))
