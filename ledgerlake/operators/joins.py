"""Joins (JN-01..JN-10).

Broadcast policy: only literal tables written in the code (vocabularies) are
hinted. Everything else is left to AQE, which measures the real side at
runtime and picks broadcast below ``autoBroadcastJoinThreshold`` and
sort-merge (with skew splitting) above it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import (BooleanType, DateType, DecimalType, FractionalType, LongType, NumericType, StringType,
                               TimestampNTZType, TimestampType)


def _prefixed(right: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    return right.select(*[F.col(k).alias(prefix + k) if k in keys else F.col(k) for k in right.columns])


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join where NULL keys match NULL keys (dplyr default, S1).

    Output keeps the left key columns (coalesced with the right ones for
    right/full joins) followed by the right non-key columns.
    """
    prefix = "__r_"
    r = _prefixed(right, keys, prefix)
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(r[prefix + k]) for k in keys])
    joined = left.join(r, cond, how)
    if how in ("left_semi", "semi", "leftsemi", "left_anti", "anti", "leftanti"):
        return joined
    if how in ("right", "right_outer", "full", "outer", "full_outer"):
        key_cols = [F.coalesce(left[k], r[prefix + k]).alias(k) for k in keys]
    else:
        key_cols = [left[k] for k in keys]
    others_left = [left[c] for c in left.columns if c not in keys]
    others_right = [r[c] for c in r.columns if not c.startswith(prefix)]
    return joined.select(*key_cols, *others_left, *others_right)


HOT_ROWS = 1_000_000  # rows of one group that a task numbers at once, whatever the input


def _places(df: DataFrame, column: str) -> tuple[list[Column], bool]:
    """Numbers that order rows as ``column`` does, coarse ones first, and
    whether they tell all its values apart. NULL places come first."""
    kind, c = df.schema[column].dataType, F.col(column)
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        kind, c = LongType(), F.unix_micros(c.cast("timestamp"))
    if isinstance(kind, LongType):  # a double holds 53 bits
        return [F.shiftright(c, 32).cast("double"), c.bitwiseAND(F.lit(0xFFFFFFFF)).cast("double")], True
    if isinstance(kind, DateType):
        return [F.unix_date(c).cast("double")], True
    if isinstance(kind, FractionalType) and not isinstance(kind, DecimalType):  # NaN is the largest
        return [F.nanvl(c.cast("double"), F.lit(float("inf"))), F.isnan(c).cast("double")], True
    if isinstance(kind, (NumericType, BooleanType)):
        return [c.cast("double")], not isinstance(kind, DecimalType)
    if isinstance(kind, StringType):  # six bytes after six, read as numbers
        raw = F.encode(c, "utf-8")
        return [F.conv(F.rpad(F.hex(F.substring(raw, i, 6)), 12, "0"), 16, 10).cast("double") for i in (1, 7, 13)], False
    return [], False


def _hot_groups(df: DataFrame, group: Column, limit: int) -> dict[int, int]:
    """{hash of a group: rows} of the groups above ``limit`` rows or 4 / n of a
    partition's share, from one pass over their columns that keeps 8 n counters."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    top = F.expr(f"approx_top_k(__group, {n}, {max(8 * n, 1000)})")
    found = df.select(group.alias("__group")).agg(top.alias("top"), F.count(F.lit(1)).alias("n")).first()
    least = max(limit, found["n"] // (4 * n))
    return {r["item"]: r["count"] for r in found["top"] or [] if r["count"] > least}


def _range_of(place: Column, group: Column, cuts: dict[int, list[float]]) -> Column:
    """Rank of ``place`` among the cuts of its group, by bisection: odd ranges
    hold one value (a cut, or NULL: -1), even ones what lies between two. 0 for
    groups that are not cut."""
    own = F.try_element_at(F.map_from_arrays(F.lit(list(cuts)).cast("array<bigint>"),
                                             F.lit(list(cuts.values())).cast("array<array<double>>")), group)
    longest = max(1, *map(len, cuts.values()))
    steps = [1 << k for k in reversed(range(longest.bit_length()))]
    below = F.aggregate(F.lit(steps), F.lit(0), lambda at, step: F.when(
        F.get(own, at + step - 1) < place, at + step).otherwise(at))
    return F.when(own.isNull(), 0).when(place.isNull(), -1).otherwise(
        2 * below + F.coalesce(F.get(own, below) == place, F.lit(False)).cast("int"))


def occurrence_number(df: DataFrame, by: Sequence[str], order: Sequence[str], name: str = "occurrence",
                      hot_rows: int = HOT_ROWS) -> DataFrame:
    """n-th row of each ``by`` group in ``order`` (WN-01), safe for a group of
    any size.

    A window by group reads and shuffles the rows once. Only groups too large
    for a task need more, and one pass over the group columns says which they
    are (their hashes and row numbers reach the driver, at most one per shuffle
    partition). Rows of a large group are dealt to ranges of the first order
    column, cut at the group's own quantiles; a value that alone fills a range
    is cut again by the next order column, and rows that tie on all of them by
    a hash of the row. A row's number is then its place in its range plus the
    group's rows in earlier ranges. Rows equal in every column share a range.
    """
    group = F.xxhash64(*by)
    hot = _hot_groups(df, group, hot_rows)
    if not hot:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    places, told_apart = [], True
    for column in order:
        if told_apart:
            found, told_apart = _places(df, column)
            places += found
    if told_apart:
        places += [F.shiftright(tie, 11).cast("double")]
    is_hot = group.isin(list(hot))
    ranged, ranges, tied = df, [], hot
    for place in places:
        part = F.xxhash64(*by, *ranges)
        parts = {g: min(1000, 2 + 2 * n // hot_rows) for g, n in tied.items()}
        probs = [i / max(parts.values()) for i in range(1, max(parts.values()))]
        quantiles = (ranged.where(is_hot).select(part.alias("__part"), place.alias("__place"))
                     .where(F.col("__part").isin(list(tied)))
                     .groupBy("__part").agg(F.percentile_approx("__place", probs, 100 * len(probs)).alias("cuts")).collect())
        cuts = {r["__part"]: sorted(set(r["cuts"] or [])) for r in quantiles}
        ranges.append(f"__range{len(ranges)}")
        ranged = ranged.withColumn(ranges[-1], _range_of(place, part, cuts))
        one_value = F.pmod(F.col(ranges[-1]), F.lit(2)) == 1
        tied = _hot_groups(ranged.where(is_hot & one_value), F.xxhash64(*by, *ranges), 2 * hot_rows)
        if not tied:
            break
    key = F.struct(*by, *ranges)  # a struct compares NULLs as equal
    earlier = Window.partitionBy(*by).orderBy(*ranges).rowsBetween(Window.unboundedPreceding, -1)
    before = (ranged.where(is_hot).groupBy(*by, *ranges).agg(F.count(F.lit(1)).alias("__n"))
              .select(key.alias("__key"), F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before")))
    inside = Window.partitionBy(*by, *ranges).orderBy(*order, tie)
    numbered = ranged.withColumn("__at", F.row_number().over(inside)).withColumn("__key", key)
    return (numbered.join(F.broadcast(before), "__key", "left")  # one row a range of a large group
            .withColumn(name, (F.col("__at") + F.coalesce("__before", F.lit(0))).cast("int")).select(*df.columns, name))


def occurrence_join(source: DataFrame, template: DataFrame, by: Sequence[str],
                    source_order: Sequence[str], template_order: Sequence[str] | None = None,
                    name: str = "occurrence") -> DataFrame:
    """Pair the n-th source row of each ``by`` group with the n-th template
    row of the same group (inner join on ``by`` + occurrence, JN-03)."""
    s = occurrence_number(source, by, source_order, name)
    t = occurrence_number(template, by, template_order or source_order, name)
    return s.join(t, [*by, name], "inner")


def missing_keys(required: DataFrame, available: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct required keys absent from ``available`` (JN-10)."""
    return required.select(*keys).distinct().join(available.select(*keys).distinct(), list(keys), "left_anti")


def grid_template(labels: DataFrame, axes: Mapping[str, Sequence]) -> DataFrame:
    """labels x fixed axes (e.g. 12 months x 2 types) without a cross join:
    each label row explodes the literal axis arrays, so the template grows
    linearly with the labels and stays partitioned like them (JN-08)."""
    out = labels
    for name, values in axes.items():
        out = out.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return out


def gap_fill(template: DataFrame, facts: DataFrame, keys: Sequence[str],
             defaults: Mapping[str, Column | object], observed: str = "observed") -> DataFrame:
    """Template LEFT JOIN facts; absent cells take defaults and ``observed``
    FALSE (JN-09, PRJ-15)."""
    flagged = facts.withColumn(observed, F.lit(True))
    joined = template.join(flagged, list(keys), "left")
    out = joined.withColumn(observed, F.coalesce(F.col(observed), F.lit(False)))
    for name, default in defaults.items():
        d = default if isinstance(default, Column) else F.lit(default)
        out = out.withColumn(name, F.coalesce(F.col(name), d))
    return out


def canonicalize_by_table(df: DataFrame, column: str, synonyms: DataFrame,
                          key: str = "key", value: str = "canonical") -> DataFrame:
    """Replace ``column`` by its canonical spelling from a synonym table keyed
    by lower-cased, squished text (PRJ-14 for large vocabularies); text
    without a synonym is kept squished."""
    from ledgerlake.functions.text import squish
    base = df.withColumn("__canon_key", F.lower(squish(column)))
    # one canonical spelling per key (the smallest if the table has several),
    # so the lookup can never duplicate a row
    syn = synonyms.groupBy(F.lower(squish(F.col(key))).alias("__canon_key")) \
        .agg(F.min(F.col(value)).alias("__canon_val"))
    return base.join(syn, "__canon_key", "left") \
        .withColumn(column, F.coalesce(F.col("__canon_val"), squish(column))) \
        .drop("__canon_key", "__canon_val")
