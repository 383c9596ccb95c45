"""Period completeness, annualisation, rebasing and extrapolation
(AG-03, AG-04, AG-06, AG-08, FLT-08, FLT-09, SO-03, UN-02, CP-10..CP-13).

Reference series have one row per year, so every frame built here is bounded
by the number of years; scalars (latest year, base-year value) are planned as
scalar subqueries, never collected to the driver and never cross-joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlake.functions.dates import DATE_FORMATS, _try_format
from ledgerlake.operators.aggregate import mean


def latest(df: DataFrame, column: str | Column) -> Column:
    """Scalar subquery: max of a column (e.g. the latest year)."""
    c = F.col(column) if isinstance(column, str) else column
    return df.select(F.max(c)).scalar()


def complete_years(df: DataFrame, year: str, unit: str, min_units: int) -> DataFrame:
    """Years having at least ``min_units`` distinct period headers (months,
    quarters). Counts headers, not values (S11)."""
    return df.where(F.col(year).isNotNull() & F.col(unit).isNotNull()) \
        .groupBy(year).agg(F.countDistinct(unit).alias("__units")) \
        .where(F.col("__units") >= min_units).select(year)


def annualize(df: DataFrame, year: str, value: str, how: str = "sum", out: str | None = None,
              scale: float = 1.0, complete: DataFrame | None = None,
              first_year: int | None = None, last_year: int | None = None) -> DataFrame:
    """Yearly sum (0 for a year of NULLs) or mean of ``value``, optionally restricted
    to a year range and to a set of complete years (left-semi join)."""
    out = out or value
    rows = df.where(F.col(year).isNotNull())
    if first_year is not None:
        rows = rows.where(F.col(year) >= first_year)
    if last_year is not None:
        rows = rows.where(F.col(year) <= last_year)
    if complete is not None:
        rows = rows.join(complete.select(year), year, "left_semi")
    v = F.col(value) * F.lit(scale) if scale != 1.0 else F.col(value)
    if how == "sum":
        agg = F.coalesce(F.sum(v), F.lit(0))
    elif how == "mean":
        agg = mean(v)
    else:
        raise ValueError(f"unknown annualisation {how!r}")
    return rows.groupBy(year).agg(agg.alias(out))


def rebase(df: DataFrame, year: str, value: str, base_year: int, out: str,
           factor: float = 100.0) -> DataFrame:
    """``out = factor * value / value[year == base_year]`` (CP-11); NULL when
    the base year is absent (reported by the reference checks)."""
    base = df.where(F.col(year) == base_year).select(F.max(F.col(value))).scalar()
    return df.withColumn(out, F.try_divide(F.lit(factor) * F.col(value), base))


def extrapolate_year(df: DataFrame, year: str, value: str, target_year: int,
                     growth: float) -> DataFrame:
    """Append ``(target_year, last value * (1 + growth))`` only if the target
    year is absent (CP-12, UN-02). One lazy plan: the appended row comes from
    a one-row aggregate filtered on non-existence."""
    last = df.agg(F.max_by(F.col(value), F.col(year)).alias("__last"),
                  F.max(F.when(F.col(year) == target_year, F.lit(1))).alias("__has"))
    extra = last.where(F.col("__has").isNull() & F.col("__last").isNotNull()).select(
        F.lit(target_year).cast(dict(df.dtypes)[year]).alias(year),
        (F.col("__last") * F.lit(1.0 + growth)).alias(value))
    return df.unionByName(extra.select(*[c for c in df.columns if c in (year, value)]),
                          allowMissingColumns=True)


def parse_dates_uniform(df: DataFrame, column: str, order: str, out: str,
                        formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """Pick ONE format for the whole column - the first format that parses the
    first non-NULL value by ``order`` - and apply it to every row (S6)."""
    text = F.trim(F.col(column).cast("string"))
    idx = None
    for i, fmt in enumerate(formats, start=1):
        cond = _try_format(text, fmt).isNotNull()
        idx = F.when(cond, F.lit(i)) if idx is None else idx.when(cond, F.lit(i))
    chosen = df.select(F.min_by(idx, F.when(F.col(column).isNotNull(), F.col(order)))).scalar()
    parsed = None
    for i, fmt in enumerate(formats, start=1):
        cond = chosen == F.lit(i)
        val = _try_format(text, fmt)
        parsed = F.when(cond, val) if parsed is None else parsed.when(cond, val)
    return df.withColumn(out, parsed)
