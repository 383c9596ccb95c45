"""Monetary measures: constant prices, US dollars and share of GDP
(CP-09, JN-05, DQ-09..DQ-13, PRJ-20)."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ledgerlake.config import DEFAULT_METHODOLOGY, MeasureColumns, MonetaryMethodology
from ledgerlake.operators.reshape import literal_frame


@dataclass
class ReferenceSeries:
    """Three yearly series: price index (base 100), nominal GDP, exchange rate.
    ``yearly``: the same three as columns of one frame, joined once where set."""

    index: DataFrame
    gdp: DataFrame
    rate: DataFrame
    yearly: DataFrame | None = None

    def named(self, m: MonetaryMethodology = DEFAULT_METHODOLOGY):
        return ((m.index_series, self.index, m.index_value),
                (m.gdp_series, self.gdp, m.gdp_value),
                (m.rate_series, self.rate, m.rate_value))


class ReferenceSeriesError(ValueError):
    pass


def validate_reference_table(df: DataFrame, name: str, value_col: str) -> None:
    """Raise on the first problem, in the reference's order: columns,
    duplicate years, missing years, missing values, non-positive values.
    One aggregate job, one row fetched."""
    missing = [c for c in ("year", value_col) if c not in df.columns]
    if missing:
        raise ReferenceSeriesError(f"Reference series '{name}' is missing columns: {', '.join(missing)}")
    y, v = F.col("year"), F.col(value_col)
    s = df.agg(F.count(F.lit(1)).alias("n"), F.count(y).alias("n_year"), F.countDistinct(y).alias("n_distinct"),
               F.count(F.when(~F.isnan(v.cast("double")), v)).alias("n_value"),
               F.count(F.when(v <= 0, F.lit(1))).alias("n_nonpositive")).first()
    nulls = s["n"] - s["n_year"]
    if s["n_year"] - s["n_distinct"] > 0 or nulls > 1:
        raise ReferenceSeriesError(f"Reference series '{name}' has duplicate years.")
    if nulls > 0:
        raise ReferenceSeriesError(f"Reference series '{name}' has missing years.")
    if s["n_value"] < s["n"]:
        raise ReferenceSeriesError(f"Reference series '{name}' has missing values in column '{value_col}'.")
    if s["n_nonpositive"] > 0:
        raise ReferenceSeriesError(f"Reference series '{name}' must be strictly positive in column '{value_col}'.")


def required_years(facts: DataFrame, year: str = "year") -> DataFrame:
    return facts.where(F.col(year).isNotNull()).select(F.col(year).cast("int").alias("year")).distinct()


def validate_references(refs: ReferenceSeries, m: MonetaryMethodology = DEFAULT_METHODOLOGY,
                        facts: DataFrame | None = None, year: str = "year") -> None:
    """Eager validation (DQ-09..DQ-13) raising the reference's messages."""
    for name, df, col in refs.named(m):
        validate_reference_table(df, name, col)
    if refs.index.where(F.col("year") == m.base_year).limit(1).count() == 0:
        raise ReferenceSeriesError(f"IPC reference series does not include the base year {m.base_year}.")
    if facts is None:
        return
    need = required_years(facts, year)
    for name, df, _ in refs.named(m):
        gap = need.join(df.select(F.col("year").cast("int").alias("year")), "year", "left_anti") \
            .agg(F.array_sort(F.collect_list("year")).alias("ys")).first()["ys"]
        if gap:
            raise ReferenceSeriesError(
                f"Reference series '{name}' is missing required years: {', '.join(map(str, gap))}")


def _long_series(refs: ReferenceSeries, m: MonetaryMethodology, names: list[str]) -> DataFrame:
    """(series, year, value) of the named series; from the one yearly frame
    where there is one, in a single pass (a year without value is not in it)."""
    picked = [(name, df, col) for name, df, col in refs.named(m) if name in names]
    value = lambda c: F.col(c).cast("double").alias("value")
    if refs.yearly is not None and picked:
        each = F.inline(F.array(*[F.struct(F.lit(name).alias("series"), value(col)) for name, _, col in picked]))
        return refs.yearly.select(F.col("year").cast("int").alias("year"), each).where("value IS NOT NULL")
    parts = [df.select(F.lit(name).alias("series"), F.col("year").cast("int").alias("year"), value(col)) for name, df, col in picked]
    return reduce(DataFrame.unionByName, parts)


def reference_checks(refs: ReferenceSeries, facts: DataFrame, m: MonetaryMethodology = DEFAULT_METHODOLOGY,
                     year: str = "year") -> DataFrame:
    """All checks as rows ``(series, check, passed, detail)``: the series as one
    long frame, the years that the facts need beside them, one aggregate by
    (series, year) and one by series - series and facts are each read once. A
    series that lacks a column has the failed ``columns`` row only."""
    spark = facts.sparkSession
    whole = [name for name, df, c in refs.named(m) if {"year", c} <= set(df.columns)]
    parts = []
    for name, df, c in refs.named(m):
        if name not in whole:  # nothing else can be checked
            missing = ", ".join(x for x in ("year", c) if x not in df.columns)
            parts.append((name, "columns", False, f"Reference series '{name}' is missing columns: {missing}"))
    failed = literal_frame(spark, parts, [("series", "string"), ("check", "string"), ("passed", "boolean"), ("detail", "string")])
    if not whole:
        return failed
    need = required_years(facts, year).select(F.explode(F.lit(whole)).alias("series"), "year", F.lit(None).cast("double").alias("value"),
                                              F.lit(1).alias("need"))
    v, have = F.col("value"), F.col("need") == 0
    per_year = _long_series(refs, m, whole).withColumn("need", F.lit(0)).unionByName(need).groupBy("series", "year").agg(
        F.count(F.when(have, F.lit(1))).alias("n"), F.count(F.when(have & ~F.isnan(v), v)).alias("n_value"),
        F.count(F.when(have & (v <= 0), F.lit(1))).alias("n_nonpositive"), F.max("need").alias("need"))
    known = F.col("year").isNotNull()
    gap = F.when((F.col("need") == 1) & (F.col("n") == 0), F.col("year").cast("string"))
    stats = per_year.groupBy("series").agg(
        F.sum("n").alias("n"), F.sum(F.when(known, F.col("n")).otherwise(0)).alias("n_year"),
        F.count(F.when(known & (F.col("n") > 0), F.lit(1))).alias("n_distinct"), F.sum("n_value").alias("n_value"),
        F.sum("n_nonpositive").alias("n_nonpositive"),
        F.max(F.coalesce((F.col("year") == m.base_year) & (F.col("n") > 0), F.lit(False))).alias("has_base"),
        F.array_join(F.array_sort(F.collect_list(gap)), ", ").alias("gaps"))
    names = literal_frame(spark, [(n,) for n in whole], [("series", "string")])
    s = names.join(stats, "series", "left").na.fill(0).na.fill("", ["gaps"]).na.fill(False, ["has_base"])
    series = F.concat(F.lit("Reference series '"), F.col("series"), F.lit("'"))
    value_col = F.element_at(F.create_map(*[F.lit(x) for name, _, c in refs.named(m) for x in (name, c)]), F.col("series"))
    nulls = F.col("n") - F.col("n_year")
    checks = [  # (name, problem, text)
        ("columns", F.lit(False), F.lit("")),
        ("unique_years", (F.col("n_year") - F.col("n_distinct") > 0) | (nulls > 1), F.concat(series, F.lit(" has duplicate years."))),
        ("non_null_years", nulls > 0, F.concat(series, F.lit(" has missing years."))),
        ("non_null_values", F.col("n_value") < F.col("n"),
         F.concat(series, F.lit(" has missing values in column '"), value_col, F.lit("'."))),
        ("positive_values", F.col("n_nonpositive") > 0,
         F.concat(series, F.lit(" must be strictly positive in column '"), value_col, F.lit("'."))),
        ("base_year", ~F.col("has_base"), F.lit(f"IPC reference series does not include the base year {m.base_year}.")),
        ("required_years", F.col("gaps") != "", F.concat(series, F.lit(" is missing required years: "), F.col("gaps")))]
    rows = F.array(*[F.struct(F.lit(c).alias("check"), (~problem).alias("passed"), F.when(problem, text).otherwise("").alias("detail"))
                     for c, problem, text in checks])
    done = s.select("series", F.inline(rows)).where((F.col("check") != "base_year") | (F.col("series") == m.index_series))
    return done.unionByName(failed) if parts else done


def augment_monetary(df: DataFrame, nominal: str, refs: ReferenceSeries,
                     m: MonetaryMethodology = DEFAULT_METHODOLOGY, year: str = "year",
                     outputs: MeasureColumns | None = None, on_missing: str = "raise",
                     constant_year: int | None = None) -> DataFrame:
    """Add ``constant = 100 * nominal / index``, ``pct = nominal / gdp`` and
    ``usd = nominal / rate`` by year.

    The series are one row per year; the planner measures and broadcasts
    them. ``on_missing="raise"`` fails the job when a fact year has no
    reference value (coverage, DQ-13): the guard is a row filter, so it holds
    whichever measures are read later. ``"null"`` leaves the measure NULL.
    """
    missing = [c for c in (year, nominal) if c not in df.columns]
    if missing:
        raise ValueError(f"augment_monetary() is missing columns: {', '.join(missing)}")
    outputs = outputs or m.annual
    if constant_year is not None:
        return _augment_constant_year(df, nominal, refs, m, year, outputs, on_missing, constant_year)
    names = [(name, ref, col, f"__ref_{col}") for name, ref, col in refs.named(m)]
    frames = [ref.select(F.col("year").cast("int").alias("__ref_year"), F.col(col).alias(tmp))
              for _, ref, col, tmp in names]
    if refs.yearly is not None:
        frames = [refs.yearly.select(F.col("year").cast("int").alias("__ref_year"),
                                     *[F.col(col).alias(tmp) for _, _, col, tmp in names])]
    out = df
    for r in frames:
        out = out.join(r, F.col(year).cast("int") == F.col("__ref_year"), "left").drop("__ref_year")
    if on_missing == "raise":
        guard = F.lit(True)
        for name, _, _, tmp in names:
            text = F.concat(F.lit(f"Reference series '{name}' is missing required years: "), F.col(year).cast("string"))
            guard = F.when(F.col(year).isNotNull() & F.col(tmp).isNull(), F.raise_error(text).cast("boolean")).otherwise(guard)
        out = out.where(guard)
    idx, gdp, rate = (F.col(tmp) for *_, tmp in names)
    v = F.col(nominal)
    return out.withColumns({outputs.constant: F.try_divide(F.lit(100.0) * v, idx), outputs.pct_gdp: F.try_divide(v, gdp),
                            outputs.usd: F.try_divide(v, rate)}).drop(*[tmp for *_, tmp in names])


def select_measure(df: DataFrame, unit: str, allowed, out: str = "ejecutado_select") -> DataFrame:
    """Runtime measure choice from an allow-list (PRJ-20)."""
    if unit not in allowed:
        raise ValueError(f"Unknown unit {unit!r}; expected one of {', '.join(allowed)}")
    return df.withColumn(out, F.col(unit))


def _augment_constant_year(df: DataFrame, nominal: str, refs: ReferenceSeries, m: MonetaryMethodology,
                           year: str, outputs: MeasureColumns, on_missing: str, constant_year: int) -> DataFrame:
    """All facts share one year (a projection): the three reference values
    are scalar subqueries - no join at all."""
    values = []
    for name, ref, col in refs.named(m):
        v = ref.where(F.col("year") == constant_year).select(F.max(F.col(col))).scalar()
        if on_missing == "raise":
            msg = f"Reference series '{name}' is missing required years: {constant_year}"
            v = F.when(v.isNull(), F.raise_error(F.lit(msg)).cast("double")).otherwise(v)
        values.append(v)
    idx, gdp, rate = values
    x = F.col(nominal)
    return df.withColumns({outputs.constant: F.try_divide(F.lit(100.0) * x, idx),
                           outputs.pct_gdp: F.try_divide(x, gdp),
                           outputs.usd: F.try_divide(x, rate)})


def add_deflators(df: DataFrame, refs: ReferenceSeries, m: MonetaryMethodology = DEFAULT_METHODOLOGY,
                  on_missing: str = "raise") -> DataFrame:
    """Projection measures for a frame with numeric ``year`` and nominal
    columns (the app-side wrapper of :func:`augment_monetary`)."""
    from pyspark.sql.types import NumericType
    types = {f.name: f.dataType for f in df.schema.fields}
    for name in ("year", m.projection.nominal):
        if not isinstance(types.get(name), NumericType):
            raise ValueError(f"Error: data frame must have a numeric column named '{name}'.")
    return augment_monetary(df, m.projection.nominal, refs, m, outputs=m.projection, on_missing=on_missing)
