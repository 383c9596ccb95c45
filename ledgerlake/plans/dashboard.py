"""Dashboard views computed for all companies at once (CP-17..CP-19, AG-11,
AG-12, PRJ-20..PRJ-23). The source computes them per request for one
company; here each is one grouped plan partitioned by company."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ledgerlake.config import (CASH_EXPENSE_LABEL, CASH_INCOME_LABEL, DEFAULT_CASH, DEFAULT_METHODOLOGY,
                               MONTH_LABELS, SERIES_TYPES, CashConfig, MonetaryMethodology)
from ledgerlake.functions.dates import month_label
from ledgerlake.functions.display import format_amount, format_money, month_year_label, panel_title
from ledgerlake.functions.numeric import is_finite
from ledgerlake.operators.aggregate import strict_sum
from ledgerlake.operators.joins import gap_fill, grid_template
from ledgerlake.operators.measures import select_measure


def kpi_totals(annual: DataFrame, unit: str = "valor", m: MonetaryMethodology = DEFAULT_METHODOLOGY,
               facet: str = "facet_col", units=None) -> DataFrame:
    """Latest-year total per facet in the chosen measure - the five KPIs in
    ONE grouped aggregate (strict sum), by year; the latest year is then found
    among the few rows per year, so the series are evaluated once."""
    d = select_measure(annual, unit, list(m.unit_choices("annual").values()))
    yearly = d.groupBy("year", facet).agg(strict_sum("ejecutado_select").alias("total"))
    last = F.max("year").over(Window.partitionBy())   # one row a year and facet
    return yearly.withColumn("__last", last).where(F.col("year") == F.col("__last")).drop("__last", "year") \
        .withColumn("label", format_amount("total", unit, units))


def facet_series(annual: DataFrame, unit: str = "valor", by: Sequence[str] = ("year", "empresa", "fill_col"),
                 m: MonetaryMethodology = DEFAULT_METHODOLOGY) -> DataFrame:
    """Yearly series by company and fill in the chosen measure, tooltips included."""
    d = select_measure(annual, unit, list(m.unit_choices("annual").values()))
    return d.groupBy("facet_col", *by).agg(strict_sum("ejecutado_select").alias("ejecutado")) \
        .withColumn("tooltip", format_amount("ejecutado", unit))


def label_order(facts: DataFrame, part: Sequence[str] = ("empresa", "facet_col"), label: str = "label",
                value: str = "valor") -> DataFrame:
    """Labels of each (company, facet) ordered by max |value| descending,
    ties by label (AG-09, SO-02). The window runs over the per-label
    aggregate, so its partitions hold labels, not facts."""
    sizes = facts.groupBy(*part, label).agg(F.max(F.abs(F.col(value))).alias("facet_size"))
    w = Window.partitionBy(*part).orderBy(F.col("facet_size").desc(), F.col(label))
    return sizes.withColumn("label_ord", F.row_number().over(w).cast("int"))


def monthly_grid(monthly: DataFrame, types: Sequence[str] = SERIES_TYPES) -> DataFrame:
    """Label-ordered, gap-filled month x type grid per company and facet
    (CP-18): finite values only; every label gets all 12 months x types;
    absent cells are 0 with ``observed`` FALSE, no tooltip, alpha 0."""
    facts = monthly.where(is_finite("valor")).select(
        "empresa", "facet_col", "label", F.month("fecha").alias("month"), "tipo", "valor",
        format_money("valor").alias("tooltip"))
    order = label_order(facts)
    template = grid_template(order.select("empresa", "facet_col", "label", "label_ord"),
                             {"month": list(range(1, 13)), "tipo": list(types)})
    grid = gap_fill(template, facts, ["empresa", "facet_col", "label", "month", "tipo"], {"valor": 0.0})
    return grid.withColumn("tooltip", F.when(F.col("observed"), F.col("tooltip"))) \
        .withColumn("alpha_value", F.when(F.col("observed"), F.lit(1.0)).otherwise(F.lit(0.0))) \
        .withColumn("month_label", month_label("month", MONTH_LABELS))


def cash_view(cash_monthly: DataFrame, cash: CashConfig = DEFAULT_CASH) -> DataFrame:
    """Balance, threshold, threshold label and tooltip per company (CP-19)."""
    e = F.col("empresa")
    line = F.when(e.isin(*cash.expense_class), F.lit(CASH_EXPENSE_LABEL)) \
        .when(e.isin(*cash.income_class), F.lit(CASH_INCOME_LABEL))
    tip = F.concat(month_year_label("fecha"), F.lit(": "), format_money("saldo"))
    return cash_monthly.select("empresa", "fecha", "saldo", "saldo_minimo", line.alias("linea_label"),
                               tip.alias("tooltip"))


def latest_company_year(monthly: DataFrame, cash_monthly: DataFrame, entity: str = "empresa",
                        date: str = "fecha") -> DataFrame:
    """Latest year over two facts per company (AG-12); NULL dates ignored."""
    both = monthly.select(entity, date).unionByName(cash_monthly.select(entity, date))
    return both.where(F.col(date).isNotNull()).groupBy(entity) \
        .agg(F.max(date).alias("latest_date")).withColumn("year", F.year("latest_date"))


def panel_titles(latest_years: DataFrame, facets: Sequence[str], entity: str = "empresa") -> DataFrame:
    """One title per company and panel (PRJ-23)."""
    return latest_years.withColumn("facet", F.explode(F.array(*[F.lit(f) for f in facets]))) \
        .withColumn("title", panel_title(entity, "facet", "year"))
