"""Aggregate expressions with the reference's NULL semantics (S2, S3, S5)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ledgerlake.functions._util import col


def strict_sum(c) -> Column:
    """Sum that is NULL as soon as one input is NULL (no NA skipping)."""
    x = col(c)
    return F.when(F.count(F.lit(1)) == F.count(x), F.sum(x))


def lenient_sum(c, zero=0.0) -> Column:
    """Sum skipping NULLs; a group of only NULLs sums to ``zero``."""
    return F.coalesce(F.sum(col(c)), F.lit(zero))


def money_sum(c, precision: int = 18, scale: int = 2) -> Column:
    """Exact decimal sum (order independent), e.g. for reconciliation."""
    return F.sum(col(c).cast(f"decimal({precision},{scale})"))


def mean(c) -> Column:
    """Mean skipping NULLs, as ``sum / count`` in double."""
    x = col(c)
    return F.sum(x).cast("double") / F.count(x)


def first_non_null(value, *order) -> Column:
    """Value of the first row (by ``order``) whose value is not NULL.

    ``min_by`` skips rows whose ordering key is NULL, so NULL values are
    excluded by nulling their key. Several order columns compare as a struct.
    """
    v = col(value)
    key = F.struct(*[col(o) for o in order]) if len(order) > 1 else col(order[0])
    return F.min_by(v, F.when(v.isNotNull(), key))


def first_code(code, order, codes: int) -> Column:
    """The code (0 .. codes - 1) of the first row by the whole number
    ``order`` whose code is not NULL; rows that tie give the smallest code.
    Order and code travel as one number, so the aggregation can hash."""
    c = col(code).cast("bigint")
    packed = F.min(F.when(c.isNotNull(), col(order).cast("bigint") * codes + c))
    return packed % codes
