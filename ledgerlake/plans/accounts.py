"""Account-plan jobs over landed sheets (CP-01..CP-16).

Inputs are landed tables, not spreadsheets: sheets as cell tables or as
row-ordinal tables (column ``row`` is the sheet row, so order-dependent steps
never rely on Spark row order). Every function returns a lazy DataFrame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlake.config import (DEFAULT_CASH, DEFAULT_METHODOLOGY, MONTH_NAMES, MONTH_SHEETS,
                               PROJECTION_HEADER_LEVELS, PROJECTION_HEADERS, PROJECTION_TAG,
                               QUARTER_HEADER_PATTERN, CashConfig, MonetaryMethodology, Rule, account_rules)
from ledgerlake.functions.dates import first_of_month, month_number, parse_date, serial_to_date, year_token
from ledgerlake.functions.lookup import code_lookup, ordinal
from ledgerlake.functions.numeric import lenient_double
from ledgerlake.functions.text import blank, canonical_label, squish, tidy_columns
from ledgerlake.operators.aggregate import first_non_null, lenient_sum, strict_sum
from ledgerlake.operators.classify import classify, normalize_code_keys
from ledgerlake.operators.joins import null_safe_join, occurrence_number
from ledgerlake.operators.measures import ReferenceSeries, augment_monetary
from ledgerlake.operators.periods import annualize, complete_years, extrapolate_year, latest, rebase
from ledgerlake.operators.reshape import has_data, literal_frame, require_columns, unpivot, union_by_name
from ledgerlake.operators.windows import running_balance
from ledgerlake.sources.cells import cells_to_long, header_values, row_of_label, select_range

CODES = ("header_code", "sub_header_code", "item_code")
YEAR = "budget_year"  # column of budget sheets that name their own year


def stop_if(df: DataFrame, cond: Column, message: str) -> DataFrame:
    """Guard: the job fails with ``message`` on the first row where ``cond``
    holds. A row filter, so no later column selection can drop it."""
    return df.where(F.when(cond, F.raise_error(F.lit(message)).cast("boolean")).otherwise(F.lit(True)))


# --- CP-01 structure maps ---------------------------------------------------

def structure_maps(sheet: DataFrame, row_offset: int = 5,
                   id_columns: Sequence[str] = ("Header", "SubHeader", "Item", "Label")):
    """Account map by sheet row and account x company labels.

    ``sheet``: the landed structure sheet with ``row`` (sheet row), Header,
    SubHeader, Item, Label and one column per company. The map row is the
    sheet row shifted to the actuals layout (``row + row_offset``).
    """
    require_columns(sheet, ["row", *id_columns], "structure sheet")
    header, sub, item, label = id_columns
    codes = [F.col(header).cast("string").alias("header_code"),
             lenient_double(F.col(sub).cast("string")).cast("int").alias("sub_header_code"),
             lenient_double(F.col(item).cast("string")).cast("int").alias("item_code")]
    by_row = sheet.select((F.col("row") + row_offset).cast("int").alias("row"), *codes,
                          F.col(label).cast("string").alias("label_estructura"))
    companies = [c for c in sheet.columns if c not in ("row", *id_columns)]
    long = unpivot(sheet.select(*codes, *[F.col(c).cast("string").alias(c) for c in companies]),
                   list(CODES), companies, "empresa", "rubro", value_type="string")
    long = long.na.drop(how="all", subset=list(CODES)).select(*CODES, "empresa", "rubro")
    return by_row, long


# --- CP-02 actuals from cell grids -----------------------------------------

def actuals_from_cells(cells: DataFrame, structure_map: DataFrame, header_row: int = 6,
                       last_row: int = 89, wide_from_year: int = 2024, narrow_last_col: int = 10,
                       wide_last_col: int = 12, months: Sequence[str] = MONTH_SHEETS) -> DataFrame:
    """Monthly actuals (thousands) from all workbooks and sheets in one job.

    ``cells`` carries ``year`` (int), ``sheet`` (month token) and, where a year
    has several, ``workbook`` besides the cell columns. Layout depends on the period: columns A..L from
    ``wide_from_year`` on, A..J before.
    """
    last_col = F.when(F.col("year") >= wide_from_year, F.lit(wide_last_col)).otherwise(F.lit(narrow_last_col))
    cut = select_range(cells, header_row, last_row, 1, last_col)
    keys = [k for k in ("workbook", "year", "sheet") if k in cells.columns]
    long = cells_to_long(cut, header_row, 1, keys=keys, structure_map=structure_map)
    return long.select("row", "empresa", *CODES, "valor",
                       month_number("sheet", months).alias("month"), F.col("year").cast("int").alias("year"))


# --- CP-03 budget sheets through a coded template ---------------------------

def _budget_rows(sheet: DataFrame, months: Sequence[str], extra: Sequence[str]) -> DataFrame:
    t = tidy_columns(sheet)
    require_columns(t, ["sheet", "row", "concepto", *months], "budget sheet")
    values = [lenient_double(F.col(m).cast("string")).alias(m) for m in months]
    rows = t.select("sheet", "row", *[c for c in extra if c in t.columns],
                    squish("concepto", null_as_empty=True).alias("concepto"), *values)
    rows = rows.where((F.col("concepto") != "") & has_data(list(months)))
    return occurrence_number(rows, ["sheet", "concepto"], ["row"], "concept_occurrence")


def budget_matched(source: DataFrame, template: DataFrame, months: Sequence[str] = MONTH_NAMES) -> DataFrame:
    """Source budget rows paired with the template row of the same concept
    and occurrence number; the template provides the account codes."""
    s = _budget_rows(source, months, (YEAR,) if YEAR in source.columns else ())
    t = _budget_rows(template, months, ("header", "sub_header", "item")) \
        .select("sheet", "concepto", "concept_occurrence", "header", "sub_header", "item")
    return s.join(t, ["sheet", "concepto", "concept_occurrence"], "inner")


def budget_unmatched(source: DataFrame, template: DataFrame, months: Sequence[str] = MONTH_NAMES) -> DataFrame:
    """Per sheet: source rows without a template partner (DQ-15)."""
    s = _budget_rows(source, months, ())
    t = _budget_rows(template, months, ()).select("sheet", "concepto", "concept_occurrence")
    return s.join(t, ["sheet", "concepto", "concept_occurrence"], "left_anti") \
        .groupBy("sheet").agg(F.count(F.lit(1)).cast("bigint").alias("dropped_rows"))


def budget_raw(source: DataFrame, template: DataFrame, label_map: DataFrame, year,
               months: Sequence[str] = MONTH_NAMES) -> DataFrame:
    """Budget facts (units) by company, month and account, labelled.

    ``label_map``: (empresa, header_code, sub_header_code, item_code, rubro).
    ``year`` may be an int or a scalar Column (e.g. the latest actuals year);
    source sheets that carry a ``budget_year`` column use their own.
    """
    matched = budget_matched(source, template, months)
    y = year if isinstance(year, Column) else F.lit(year)
    ids = ["sheet", "row", "concepto", "header", "sub_header", "item"]
    if YEAR in matched.columns:
        ids, y = [*ids, YEAR], F.col(YEAR)
    long = unpivot(matched.select(*ids, *months), ids, list(months), "mes", "firmado")
    long = long.select(
        F.col("sheet").alias("empresa"),
        first_of_month(y, month_number("mes", months)).alias("fecha"),
        F.col("header").cast("string").alias("header_code"),
        lenient_double(F.col("sub_header").cast("string")).cast("int").alias("sub_header_code"),
        lenient_double(F.col("item").cast("string")).cast("int").alias("item_code"),
        F.col("concepto").alias("label_excel"),
        (F.lit(1e3) * F.col("firmado")).alias("valor"),
        "row")
    summed = long.groupBy("empresa", "fecha", *CODES).agg(
        lenient_sum("valor").alias("valor"),
        first_non_null("label_excel", "row").alias("label_excel"))
    labels = label_map.select("empresa", *CODES, F.col("rubro").alias("label"))
    out = null_safe_join(summed, labels, ["empresa", *CODES], "left")
    return out.select("empresa", *CODES, F.coalesce("label", "label_excel").alias("label"), "fecha", "valor")


# --- CP-04 classify budget rows --------------------------------------------

def budget_monthly(raw: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Classified budget rows; a blank label fails the job (DQ-07)."""
    rows = raw.where(F.col("header_code").isNotNull() & F.col("sub_header_code").isNotNull() &
                     F.col("item_code").isNotNull()) \
        .where(F.col("header_code").isin("A", "B", "D", "F", "H"))
    out = classify(rows, rules or account_rules())
    out = stop_if(out, blank("label"), "budget_monthly(): found rows with missing/blank label.")
    return out.select("fecha", "label", "empresa", "facet_col", "fill_col", "valor", *CODES)


# --- CP-05 label map ---------------------------------------------------------

def label_map(structure_by_company: DataFrame) -> DataFrame:
    """Normalised label dimension, unique by (empresa, codes) (DQ-08: the job
    fails if a key repeats after normalisation)."""
    label_col = "label" if "label" in structure_by_company.columns else "rubro"
    m = normalize_code_keys(structure_by_company.select("empresa", *CODES, F.col(label_col).alias("label")))
    per_key = F.count(F.lit(1)).over(Window.partitionBy("empresa", *CODES))
    m = stop_if(m.withColumn("__per_key", per_key), F.col("__per_key") > 1,
                "label map has duplicate keys after normalization.")
    return m.select("empresa", *CODES, "label")


# --- CP-06 / CP-08 standardise and compare actual vs budget -----------------

def filter_to_keys(facts: DataFrame, key_rows: DataFrame) -> DataFrame:
    """Facts whose (empresa, year, month, codes) has a key row, NULLs matching
    (JN-04). Returns ``facts`` unchanged if ``key_rows`` lacks a key column."""
    keys = ["empresa", "year", "month", *CODES]
    if not all(k in key_rows.columns for k in keys):
        return facts
    k = normalize_code_keys(key_rows).select(*keys).distinct()
    return null_safe_join(normalize_code_keys(facts), k, keys, "left_semi")


def standardize(df: DataFrame, tipo: str, labels: DataFrame, multiplier: float = 1.0,
                rules: Sequence[Rule] | None = None) -> DataFrame:
    """normalise -> classify -> label -> canonical label -> scale -> tag -> distinct."""
    out = classify(normalize_code_keys(df), rules or account_rules())
    out = null_safe_join(out, labels, ["empresa", *CODES], "left")
    out = out.withColumn("label", canonical_label("label"))
    out = stop_if(out, blank("label"), f"{tipo} has classified rows with missing labels.")
    out = out.withColumn("valor", F.lit(float(multiplier)) * F.col("valor")).withColumn("tipo", F.lit(tipo))
    return out.select("empresa", "facet_col", "fill_col", "label", "year", "month", "valor", "tipo",
                      *CODES).distinct()


def series_monthly(actuals: DataFrame, budget: DataFrame, structure_by_company: DataFrame,
                   rules: Sequence[Rule] | None = None) -> DataFrame:
    """Actual (cut to budget keys) and budget, standardised and unioned (CP-08)."""
    b = budget.select("empresa", *CODES, F.year("fecha").alias("year"), F.month("fecha").alias("month"), "valor")
    labels = label_map(structure_by_company)
    a = filter_to_keys(actuals, b)
    out = union_by_name(standardize(a, "Ejecutado", labels, 1e3, rules),
                        standardize(b, "Firmado", labels, 1.0, rules))
    return out.select(first_of_month("year", "month").alias("fecha"), "empresa", "facet_col", "fill_col",
                      "label", "valor", "tipo", *CODES)


# --- CP-07 annual series -----------------------------------------------------

def annual_branches() -> Column:
    """The five disjoint account branches of the annual series as ONE
    predicate (one scan instead of five)."""
    h, s, i = F.col("header_code"), F.col("sub_header_code"), F.col("item_code")
    detail = s.isNotNull() & i.isNotNull() & (i != 0)
    pred = ((h == "A") & s.isNull() & i.isNull()) | ((h == "B") & detail) | ((h == "H") & (s == 1)) | \
        ((h == "D") & detail) | ((h == "F") & detail)
    return F.coalesce(pred, F.lit(False))


def series_annual(actuals: DataFrame, refs: ReferenceSeries, m: MonetaryMethodology = DEFAULT_METHODOLOGY,
                  rules: Sequence[Rule] | None = None, on_missing: str = "raise") -> DataFrame:
    """Yearly sums by company, facet and fill (units) in four measures."""
    rows = classify(actuals.where(annual_branches()), rules or account_rules())
    sums = rows.withColumn("valor", F.lit(1e3) * F.col("valor")) \
        .groupBy("empresa", "year", "facet_col", "fill_col").agg(strict_sum("valor").alias("valor"))
    out = augment_monetary(sums, "valor", refs, m, outputs=m.annual, on_missing=on_missing)
    c = m.annual
    return out.select("empresa", "year", "facet_col", "fill_col", c.nominal, c.constant, c.pct_gdp, c.usd)


# --- CP-10..CP-13 reference series ------------------------------------------

def gdp_series(cells: DataFrame, m: MonetaryMethodology = DEFAULT_METHODOLOGY, header_row: int = 6,
               total_row: int = 19, pattern: str = QUARTER_HEADER_PATTERN, scale: float = 1e6,
               total_label: str | None = None) -> DataFrame:
    """Annual nominal GDP from quarter columns: complete years (>= 4 quarter
    headers) in [first_year, projection_year], summed x ``scale``, with the
    projection year extrapolated if absent. The total row is ``total_row``
    or, if ``total_label`` is given, the row labelled so in column 1."""
    value_row = row_of_label(cells, total_label) if total_label else total_row
    q = header_values(cells, header_row, value_row, pattern) \
        .select(year_token("header").alias("year"), "col", lenient_double("text").alias("value"))
    done = q.where(F.col("year").isNotNull()).groupBy("year").agg(F.count("col").alias("n")) \
        .where(F.col("n") >= 4).select("year")
    annual = annualize(q, "year", "value", "sum", out=m.gdp_value, scale=scale, complete=done,
                       first_year=m.first_year, last_year=m.projection_year)
    return extrapolate_year(annual, "year", m.gdp_value, m.projection_year, m.gdp_growth_for_projection)


def index_series(sheet: DataFrame, m: MonetaryMethodology = DEFAULT_METHODOLOGY, period_col: str = "c1",
                 value_col: str = "c2") -> DataFrame:
    """Price index: serial-dated monthly values, complete years only (12
    distinct months), yearly mean rebased to 100 in the base year."""
    d = sheet.select(serial_to_date(period_col).alias("d"), lenient_double(value_col).alias("v")) \
        .select(F.year("d").alias("year"), F.month("d").alias("month"), "v")
    done = complete_years(d, "year", "month", 12)
    annual = annualize(d, "year", "v", "mean", out="__mean", complete=done,
                       first_year=m.first_year, last_year=m.projection_year)
    return rebase(annual, "year", "__mean", m.base_year, m.index_value).select("year", m.index_value)


def rate_series(sheet: DataFrame, m: MonetaryMethodology = DEFAULT_METHODOLOGY, date_col: str = "c1",
                value_col: str = "c3", skip_rows: int = 1) -> DataFrame:
    """Exchange rate: mean of daily quotes per year, no completeness test."""
    rows = sheet.where(F.col("row") > skip_rows) if "row" in sheet.columns else sheet
    d = rows.select(F.year(parse_date(date_col)).alias("year"), lenient_double(value_col).alias("v"))
    return annualize(d, "year", "v", "mean", out=m.rate_value, first_year=m.first_year,
                     last_year=m.projection_year)


def macro_series(gdp_cells: DataFrame, index_sheet: DataFrame, rate_sheet: DataFrame,
                 m: MonetaryMethodology = DEFAULT_METHODOLOGY) -> ReferenceSeries:
    return ReferenceSeries(index_series(index_sheet, m), gdp_series(gdp_cells, m), rate_series(rate_sheet, m))


# --- CP-14 projections -----------------------------------------------------

def projections(sheet: DataFrame, refs: ReferenceSeries, m: MonetaryMethodology = DEFAULT_METHODOLOGY,
                id_columns: Sequence[str] = ("header", "SubHeader", "Item", "label"),
                extra_columns: Sequence[str] = ("rubro",), on_missing: str = "raise") -> DataFrame:
    """Projection sheet by company, coded, ordered, in four measures, tagged."""
    header, sub, item, label = id_columns
    kept = sheet.where(F.col(label).isNotNull() & F.col(header).isNotNull() & F.col(sub).isNotNull())
    companies = [c for c in sheet.columns if c not in (*id_columns, *extra_columns, "row")]
    long = unpivot(kept.select(F.col(header).cast("string").alias("header"), F.col(label).alias("label"),
                               *[lenient_double(F.col(c).cast("string")).alias(c) for c in companies]),
                   ["header", "label"], companies, "ente", "ejecutado")
    c = m.projection
    long = long.select(code_lookup("header", PROJECTION_HEADERS).alias("header"), "label", "ente",
                       (F.col("ejecutado") * F.lit(1e3)).alias(c.nominal),
                       F.lit(m.projection_year).alias("year"))
    long = long.withColumn("header_ord", ordinal("header", PROJECTION_HEADER_LEVELS)) \
               .withColumn("ente_ord", ordinal("ente", companies))
    out = augment_monetary(long, c.nominal, refs, m, outputs=c, on_missing=on_missing,
                           constant_year=m.projection_year)
    return out.withColumn("tipo", F.lit(PROJECTION_TAG)).select(
        "header", "label", "ente", c.nominal, "year", c.constant, c.pct_gdp, c.usd, "tipo", "header_ord", "ente_ord")


# --- CP-15 cash balance ------------------------------------------------------

def cash_opening(sheet: DataFrame, year, cash: CashConfig = DEFAULT_CASH) -> DataFrame:
    """Opening balance (units) per company dated January 1st of ``year``."""
    y = year if isinstance(year, Column) else F.lit(year)
    override = code_lookup("empresa", cash.opening_overrides) if cash.opening_overrides else F.lit(None)
    return sheet.select("empresa", F.coalesce(F.lit(1e3) * F.col("saldo_inicial_miles").cast("double"),
                                              override.cast("double")).alias("saldo"),
                        F.make_date(y, F.lit(1), F.lit(1)).alias("fecha"))


def cash_monthly(actuals: DataFrame, opening_sheet: DataFrame, cash: CashConfig = DEFAULT_CASH) -> DataFrame:
    """Running cash balance of the latest year with the minimum threshold:
    one month of previous-year income (income class) or a fixed amount
    (expense class)."""
    spark = actuals.sparkSession
    latest_year = latest(actuals, "year")
    h, s, i = cash.movement_account
    moves = actuals.where((F.col("year") == latest_year) & (F.col("header_code") == h) &
                          (F.col("sub_header_code") == s) & (F.col("item_code") == i)) \
        .select(*CODES, "empresa", first_of_month("year", "month").alias("fecha"),
                (F.lit(1e3) * F.col("valor")).alias("valor"))
    min_income = actuals.where((F.col("year") == latest_year - 1) & (F.col("header_code") == cash.income_account) &
                               F.col("sub_header_code").isNull() & F.col("item_code").isNull()) \
        .groupBy("empresa").agg((strict_sum("valor") / F.lit(12.0)).alias("saldo_minimo_ingresos"))
    min_expense = F.broadcast(literal_frame(
        spark, [(k, v / 1e3) for k, v in cash.expense_minimums.items()],
        [("empresa", "string"), ("saldo_minimo_gastos", "double")]))
    opening = cash_opening(opening_sheet, latest_year, cash)
    # balance at the company x month grain: movements are summed per month
    # before the window, so a company's window partition holds <= 12 rows
    bal = running_balance(moves.join(opening, ["empresa", "fecha"], "left"), "empresa", "fecha", "valor", "saldo",
                          pre_aggregate=True)
    bal = bal.select(F.lit(h).alias("header_code"), F.lit(s).cast("int").alias("sub_header_code"),
                     F.lit(i).cast("int").alias("item_code"), "empresa", "fecha", "saldo")
    out = bal.select(*CODES, "empresa", "fecha", "saldo") \
        .join(min_expense, "empresa", "left").join(min_income, "empresa", "left")
    e = F.col("empresa")
    minimum = F.when(e.isin(*cash.income_class), F.col("saldo_minimo_ingresos")) \
        .when(e.isin(*cash.expense_class), F.col("saldo_minimo_gastos"))
    return out.withColumn("saldo_minimo", F.lit(1e3) * minimum).select(
        *CODES, "empresa", "saldo", "saldo_minimo_gastos", "saldo_minimo_ingresos", "saldo_minimo", "fecha")

