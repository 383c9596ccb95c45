"""Sparse cell grids -> long facts (SRC-02..SRC-06, JN-01, CP-02).

A landed sheet is a cell table ``(workbook, sheet, row, col, numeric,
character)``, one row per non-empty cell. Everything is keyed by
``(workbook, sheet)`` so all sheets of all workbooks resolve in one job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType


CELL_SCHEMA = StructType([
    StructField("workbook", StringType()),
    StructField("sheet", StringType()),
    StructField("row", IntegerType()),
    StructField("col", IntegerType()),
    StructField("numeric", DoubleType()),
    StructField("character", StringType()),
])

SHEET_KEYS = ("workbook", "sheet")


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    """One read over ``workbook=/sheet=`` partition folders: the origin tags
    come from partition discovery (SRC-04); filters on them prune folders."""
    return spark.read.option("basePath", path).parquet(path)


def select_range(cells: DataFrame, first_row, last_row, first_col, last_col) -> DataFrame:
    """Cells inside the rectangle (bounds may be Columns, e.g. a layout that
    depends on the period, SRC-05). Literal bounds push down to Parquet."""
    r, c = F.col("row"), F.col("col")
    return cells.where((r >= col_or_lit(first_row)) & (r <= col_or_lit(last_row)) &
                       (c >= col_or_lit(first_col)) & (c <= col_or_lit(last_col)))


def col_or_lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def cells_to_long(cells: DataFrame, header_row: int, label_col: int = 1,
                  keys: Sequence[str] = SHEET_KEYS, structure_map: DataFrame | None = None,
                  entity: str = "empresa", label: str = "label", value: str = "valor") -> DataFrame:
    """Resolve numeric cells against the header row (entity per column) and
    the label column (label per row), LEFT joins as in the source (SRC-03).

    The header and label cells of a sheet become two maps (their size is the
    sheet's layout), so cells meet them in one join on the sheet's keys.
    ``structure_map`` (keyed by ``row``) adds account codes to labelled rows.
    A sheet with values and no header at all is unusable: it stops the job
    (a row filter, so no later column selection drops the check).
    """
    k = list(keys)
    text = F.col("character")
    is_head = (F.col("row") == header_row) & text.isNotNull() & (text != "")
    is_label = (F.col("col") == label_col) & text.isNotNull()

    def lookup(cond: Column, position: str) -> Column:
        entries = F.collect_list(F.when(cond, F.struct(F.col(position).alias("k"), text.alias("v"))))
        return F.map_from_entries(F.array_distinct(entries))
    sheet = F.struct(*k).alias("__sheet")  # a struct key lets a NULL workbook match itself
    layout = cells.where(is_head | is_label).groupBy(sheet).agg(lookup(is_head, "col").alias("__heads"),
                                                             lookup(is_label, "row").alias("__labels"))
    values = cells.where(F.col("numeric").isNotNull()).select(*k, sheet, "row", "col", F.col("numeric").alias(value))
    named = F.concat_ws(" ", *[F.col(f"__sheet.{c}").cast("string") for c in k])
    headless = F.coalesce(F.size("__heads"), F.lit(0)) <= 0
    unusable = F.raise_error(F.concat(F.lit(f"Sheet without a header in row {header_row}: "), named)).cast("boolean")
    out = values.join(layout, "__sheet", "left").where(F.when(headless, unusable).otherwise(F.lit(True))) \
        .withColumn(entity, F.try_element_at("__heads", F.col("col"))) \
        .withColumn(label, F.try_element_at("__labels", F.col("row"))).drop("__heads", "__labels", "__sheet")
    if structure_map is None:
        return out
    codes = structure_map.withColumnRenamed("row", "__row")
    return out.join(codes, (F.col("row") == F.col("__row")) & F.col(label).isNotNull(), "left").drop("__row")


def header_values(cells: DataFrame, header_row: int, value_row, pattern: str,
                  keys: Sequence[str] = SHEET_KEYS) -> DataFrame:
    """Columns whose header text (``header_row``) matches ``pattern`` with the
    text of ``value_row`` below them (SRC-06). ``value_row`` may be a scalar
    Column, e.g. the row found by its label (:func:`row_of_label`)."""
    k = list(keys)
    heads = cells.where((F.col("row") == header_row) & F.col("character").rlike(pattern)) \
        .select(*k, "col", F.col("character").alias("header"))
    vals = cells.where(F.col("row") == col_or_lit(value_row)) \
        .select(*k, "col", F.coalesce(F.col("character"), F.col("numeric").cast("string")).alias("text"))
    return heads.join(vals, [*k, "col"], "left")


def text_column(cells: DataFrame, column: int, skip_rows: int = 0,
                keys: Sequence[str] = SHEET_KEYS, name: str = "text") -> DataFrame:
    """One column of a headerless text sheet, first ``skip_rows`` rows
    skipped (SRC-07: forced text, rows addressed by ordinal)."""
    return cells.where((F.col("col") == column) & (F.col("row") > skip_rows)) \
        .select(*keys, "row", F.coalesce(F.col("character"), F.col("numeric").cast("string")).alias(name))


def row_of_label(cells: DataFrame, label: str, label_col: int = 1) -> Column:
    """Scalar subquery: the first row whose label cell equals ``label``
    (trimmed, case-insensitive) - addressing a row by its label instead of
    a fixed position."""
    hit = cells.where((F.col("col") == label_col) &
                      (F.lower(F.trim(F.col("character"))) == F.lit(label.strip().lower())))
    return hit.select(F.min("row")).scalar()
