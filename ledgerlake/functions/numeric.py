"""Numeric columns (PRJ-04, PRJ-12, FLT-07)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ledgerlake.functions._util import col


NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def lenient_double(c) -> Column:
    """Text -> double; junk becomes NULL instead of failing (ANSI-safe). Only
    plain numbers count: type suffixes (``12d``, ``3f``) and ``NaN`` are junk."""
    x = col(c).cast("string")
    return F.when(x.rlike(NUMBER), F.trim(x).try_cast("double"))


def is_finite(c) -> Column:
    """Not NULL, not NaN, not +-Infinity."""
    x = col(c)
    return F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), F.lit(False))
