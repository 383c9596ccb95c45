"""Data-quality operators (DQ-02, DQ-03, DQ-07, DQ-08, DQ-14, DQ-17, AG-05, UN-04).

Checks are single aggregates per table and stay lazy.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import NumericType

from ledgerlake.functions.text import blank
from ledgerlake.operators.reshape import literal_frame


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_col: str = "n") -> DataFrame:
    """Key tuples occurring more than once, with their counts (AG-05).
    The partial count runs map-side, so a hot key only ships one row per task."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias(count_col)) \
        .where(F.col(count_col) > 1)


def key_profile(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: total rows, distinct keys, duplicated key groups (DQ-02/03)."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return per_key.agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("rows"),
                       F.count(F.lit(1)).cast("bigint").alias("keys"),
                       F.count(F.when(F.col("__n") > 1, F.lit(1))).cast("bigint").alias("duplicated_keys"))


def blank_count(df: DataFrame, column: str) -> DataFrame:
    """One row: rows and rows whose ``column`` is NULL or blank (DQ-07)."""
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"),
                  F.count(F.when(blank(column), F.lit(1))).cast("bigint").alias("n_bad"))


def _number(c: Column) -> Column:
    """Double with NaN as NULL (both are missing values)."""
    x = c.cast("double")
    return F.when(~F.isnan(x), x)


def _pairs(actual: DataFrame, expected: DataFrame, keys: Sequence[str], values: Sequence[Column],
           names: Sequence[str]) -> DataFrame:
    """Rows of two frames side by side: (n, in_a, in_e, a, e), ``a`` and ``e``
    structs of the values, ``n`` the row pairs that a line stands for.

    Both frames are tagged, united and counted by (key, values): equal rows of
    a key pair off inside the counts, which are combined before the shuffle, so
    a row repeated a million times is one line. What is left of a key pairs
    n-th with n-th in the order of the values. Each frame is read once.
    """
    def side(df: DataFrame, in_a: int) -> DataFrame:
        return df.select(F.struct(*keys).alias("__key"), F.struct(*[v.alias(n) for v, n in zip(values, names)]).alias("__v"),
                         F.lit(in_a).alias("__a"), F.lit(1 - in_a).alias("__e"))
    counts = side(actual, 1).unionByName(side(expected, 0)).groupBy("__key", "__v").agg(
        F.sum("__a").alias("__a"), F.sum("__e").alias("__e"))
    same = F.least("__a", "__e")
    copies = [F.array_repeat(F.lit(tag), F.col(column).cast("int") - same.cast("int")) for tag, column in (("a", "__a"), ("e", "__e"))]
    lines = counts.select("__key", "__v", same.alias("__same"), F.explode(F.concat(
        F.array_repeat(F.lit("="), F.least(same, F.lit(1)).cast("int")), *copies)).alias("__side"))
    equal = F.col("__side") == "="
    nth = F.row_number().over(Window.partitionBy("__key", "__side").orderBy("__v"))
    value = lambda tag: F.first(F.when(F.col("__side") == tag, F.col("__v")), ignorenulls=True)
    has = lambda tag: F.max(equal | (F.col("__side") == tag))
    # equal rows differ in nothing: their values are not needed
    return (lines.withColumn("__nth", nth).groupBy("__key", equal.alias("__equal"), "__nth")
            .agg(F.max(F.when(equal, F.col("__same")).otherwise(1)).alias("n"), has("a").alias("in_a"), has("e").alias("in_e"),
                 value("a").alias("a"), value("e").alias("e")))


def _sizes() -> list[Column]:
    """Rows of each side and rows without a partner, of :func:`_pairs`."""
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).cast("bigint")
    return [total(F.col("in_a")).alias("rows_actual"), total(F.col("in_e")).alias("rows_expected"),
            total(~(F.col("in_a") & F.col("in_e"))).alias("rows_unmatched")]


def _difference(actual: Column, expected: Column, both: Column, tolerance: float) -> tuple[Column, Column]:
    """(difference, missing on one side only) of matched rows: over the rows
    that differ, the mean absolute difference relative to the mean expected
    magnitude, or absolute where that magnitude is not above the tolerance."""
    differ = both & (actual != expected)
    n = F.count(F.when(differ, F.lit(1)))
    diff, size = F.sum(F.when(differ, F.abs(actual - expected))), F.sum(F.when(differ, F.abs(expected)))
    value = F.when(n == 0, 0.0).when(size / n > tolerance, diff / size).otherwise(diff / n)
    return value, F.count(F.when(both & (actual.isNull() != expected.isNull()), F.lit(1)))


def reconcile(actual: DataFrame, expected: DataFrame, keys: Sequence[str], value: str,
              tolerance: float = 1e-6) -> DataFrame:
    """Compare two frames on ``keys`` (DQ-14): rows on both sides, rows on one
    side only, values missing on one side only, and the mean difference over
    the rows that differ (NULL keys match NULL keys). Equal rows of a repeated
    key pair off, the others n-th with n-th in the order of their values."""
    both = F.col("in_a") & F.col("in_e")
    diff, lost = _difference(F.col("a.v"), F.col("e.v"), both, tolerance)
    out = _pairs(actual, expected, keys, [_number(F.col(value))], ["v"]).agg(
        *_sizes(), lost.cast("bigint").alias("null_mismatches"), diff.alias("mean_rel_diff"))
    ok = (F.col("rows_unmatched") == 0) & (F.col("null_mismatches") == 0) & (F.col("mean_rel_diff") <= tolerance)
    return out.withColumn("within_tolerance", ok)


def domain_check(df: DataFrame, column: str, expected: Sequence, domain: str | None = None) -> DataFrame:
    """Set equality of a column's values against an expected set (UN-04,
    DQ-17): one row per value that is unexpected (a NULL value too) or
    missing. The column is read once."""
    exp = literal_frame(df.sparkSession, [(str(v), True) for v in expected],
                        [("__e", "string"), ("__expected", "boolean")])
    actual = df.select(F.col(column).cast("string").alias("value"), F.lit(True).alias("__seen")).distinct()
    both = actual.join(exp, F.col("value").eqNullSafe(F.col("__e")), "full_outer")
    one = both.where(F.col("__seen").isNull() | F.col("__expected").isNull())
    return one.select(F.lit(domain or column).alias("domain"), F.coalesce("value", "__e").alias("value"),
                      F.when(F.col("__seen").isNull(), F.lit("missing")).otherwise(F.lit("unexpected")).alias("side"))


def issues_frame(spark: SparkSession, issues: list[dict]) -> DataFrame:
    """Issue rows (type, id, output_path, produced_by, detail, regenerate)."""
    cols = ["type", "id", "output_path", "produced_by", "detail", "regenerate"]
    return literal_frame(spark, [tuple(i.get(c) for c in cols) for i in issues], [(c, "string") for c in cols])


def reconcile_frames(actual: DataFrame, expected: DataFrame, keys: Sequence[str],
                     tolerance: float = 1e-6) -> DataFrame:
    """Whole-frame equality within tolerance (DQ-14): one row per non-key
    column with its kind, the rows on each side and on one side only, and

    * numeric columns: the mean difference over the rows that differ (see
      :func:`reconcile`) and the rows where one side is missing;
    * other columns: the number of matched rows whose values differ.

    Rows are paired as in :func:`reconcile` (a text or number in any column
    makes rows differ) and ONE aggregate serves all columns; a column present
    on only one side is reported with kind ``missing``.
    """
    a_types = {f.name: f.dataType for f in actual.schema.fields}
    e_types = {f.name: f.dataType for f in expected.schema.fields}
    cols = [c for c in actual.columns if c not in keys and c in e_types]
    missing = sorted((set(a_types) ^ set(e_types)) - set(keys))
    numeric = {c: isinstance(a_types[c], NumericType) and isinstance(e_types[c], NumericType) for c in cols}

    def value(c: str) -> Column:
        return _number(F.col(c)) if numeric[c] else F.col(c).cast("string")
    j = _pairs(actual, expected, keys, [value(c) for c in cols] or [F.lit(0)], cols or ["__none"])
    both = F.col("in_a") & F.col("in_e")
    aggs = _sizes()
    for c in cols:
        x, y = F.col("a")[c], F.col("e")[c]
        if numeric[c]:
            diff, lost = _difference(x, y, both, tolerance)
        else:
            diff, lost = F.lit(None).cast("double"), F.count(F.when(both & ~x.eqNullSafe(y), F.lit(1)))
        aggs += [diff.alias(f"d__{c}"), lost.alias(f"n__{c}")]
    rows = [F.struct(F.lit(c).alias("column"), F.lit("numeric" if numeric[c] else "text").alias("kind"),
                     F.col(f"d__{c}").alias("mean_rel_diff"), F.col(f"n__{c}").cast("bigint").alias("mismatches"))
            for c in cols]
    rows += [F.struct(F.lit(c).alias("column"), F.lit("missing").alias("kind"),
                      F.lit(None).cast("double").alias("mean_rel_diff"), F.lit(None).cast("bigint").alias("mismatches"))
             for c in missing]
    out = j.agg(*aggs).select("rows_actual", "rows_expected", "rows_unmatched", F.explode(F.array(*rows)).alias("r")) \
        .select("r.column", "r.kind", "rows_actual",
                "rows_expected", "rows_unmatched", "r.mean_rel_diff", "r.mismatches")
    ok = (F.col("kind") != "missing") & (F.col("rows_unmatched") == 0) & \
        (F.coalesce(F.col("mismatches"), F.lit(0)) == 0) & \
        (F.coalesce(F.col("mean_rel_diff"), F.lit(0.0)) <= F.lit(tolerance))
    return out.withColumn("within_tolerance", ok)
