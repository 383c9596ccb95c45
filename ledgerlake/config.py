"""Configuration: methodology, classification rules, entity classes, contracts.

Everything the jobs need to know about the account plan lives here as data,
once: the rule list is used by every classifying job, the entity classes by
the cash job and the cash view.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values. These must equal the source system's values for the results
# to agree; they are stated here plainly, in their natural order.
# ---------------------------------------------------------------------------

# Month vocabularies: sheet names of the actuals workbooks, column headers of
# the budget sheets, and the display labels of the monthly grid.
MONTH_SHEETS = ("ENE", "FEB", "MAR", "ABR", "MAY", "JUN",
                "JUL", "AGO", "SET", "OCT", "NOV", "DIC")
MONTH_NAMES = ("enero", "febrero", "marzo", "abril", "mayo", "junio",
               "julio", "agosto", "setiembre", "octubre", "noviembre", "diciembre")
MONTH_LABELS = ("Ene", "Feb", "Mar", "Abr", "May", "Jun",
                "Jul", "Ago", "Sept", "Oct", "Nov", "Dic")

# Budget sheets, one per company.
COMPANIES = ("AFE", "ANCAP", "ANCO", "ANP", "ANTEL", "ANV",
             "INC", "OSE", "UTE", "URSEC", "URSEA")

# Cash minimum: companies whose minimum is one month of income, and those
# whose minimum is a fixed amount (one month of expenses plus taxes).
CASH_INCOME_CLASS = ("ANP", "ANTEL", "OSE", "URSEA", "URSEC", "UTE")
CASH_EXPENSE_CLASS = ("AFE", "ANCAP", "ANCO", "ANV", "INC")
CASH_INCOME_LABEL = "Un mes de Ingresos "
CASH_EXPENSE_LABEL = "Un mes de Gastos + Impuestos"

# Opening balance overrides (units) used when the opening sheet is blank.
CASH_OPENING_OVERRIDES = {"ANTEL": 2966359000.0}

# Fixed monthly expense minimums (units).
CASH_EXPENSE_MINIMUMS = {
    "AFE": 172474688.0,
    "ANCAP": 21822288449.0,
    "ANCO": 687419343.0,
    "ANP": 837957269.0,
    "ANTEL": 4287138308.0,
    "ANV": 299242798.0,
    "INC": 96049414.0,
    "OSE": 3521200565.0,
    "URSEA": 42319191.0,
    "URSEC": -14122269.0,
    "UTE": 11180550608.0,
}

# Projection sheet: header code -> facet name, and the facet display order.
PROJECTION_HEADERS = {
    "A": "Ingresos",
    "B": "Gastos",
    "D": "Impuestos y Transferencias",
    "E": "Resultado",
    "F": "Inversiones",
    "G": "Transferencias de Capital",
}
PROJECTION_HEADER_LEVELS = ("Ingresos", "Gastos", "Impuestos y Transferencias",
                            "Resultado", "Transferencias de Capital", "Inversiones")
PROJECTION_TAG = "Proyección"

# Monthly series: source tags, in display order.
SERIES_TYPES = ("Ejecutado", "Firmado")

# Label spellings fixed by case-insensitive match.
CANONICAL_LABELS = {"otros ingresos": "Otros Ingresos"}

# Panel titles of the monthly view, by facet (I = cash).
FACET_TITLES = {
    "Ingresos": "Ingresos Corrientes",
    "Gastos": "Gastos",
    "Impuestos y Transferencias": "Transferencias e impuestos",
    "Inversiones": "Inversiones",
    "Resultado": "Resultado",
    "I": "Caja Mensual",
}

# Date formats tried, in order, for text dates of the exchange-rate sheet
# (R strptime %d-%m-%Y, %d/%m/%Y, %Y-%m-%d written as Spark patterns).
DATE_FORMATS = ("d-M-yyyy", "d/M/yyyy", "yyyy-M-d")

# Spreadsheet serial day 0.
SERIAL_ORIGIN = "1899-12-30"

# Quarter header of the GDP sheet, e.g. "IV 2024*".
QUARTER_HEADER_PATTERN = r"^[IVX]+ [0-9]{4}"
YEAR_TOKEN_PATTERN = r"([0-9]{4})\*?"

# Display units: column -> (kind, prefix).
DISPLAY_UNITS = {
    "valor": ("money", "$ "),
    "valor_2024": ("money", "$ "),
    "valor_usd": ("money", "US$ "),
    "valor_pct_pib": ("percent", ""),
    "ejecutado": ("money", "$ "),
    "ejecutado_2024": ("money", "$ "),
    "ejecutado_usd": ("money", "US$ "),
    "ejecutado_pct_pib": ("percent", ""),
}

# ---------------------------------------------------------------------------
# Classification rules
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """One ordered classification rule over (header, sub, item, entity).

    A field left ``None`` matches anything; ``items`` is a set of item codes.
    """

    fill: str
    facet: str
    header: str
    sub: int | None = None
    items: tuple[int, ...] | None = None
    entity: str | None = None


def account_rules(stock_entity: str = "ANCAP") -> tuple[Rule, ...]:
    """The account plan's facet/fill rules, first match wins.

    ``stock_entity`` is the one company whose F/3 rows are stock variation.
    """
    return (
        Rule("Ingresos", "Ingresos", "A"),
        Rule("Sueldos", "Gastos", "B", sub=1),
        Rule("Compras", "Gastos", "B", sub=2),
        Rule("Intereses", "Gastos", "B", sub=3),
        Rule("Impuestos", "Impuestos y Transferencias", "D", items=(1, 2, 3, 6, 7, 8, 9, 10, 11)),
        Rule("BPS", "Impuestos y Transferencias", "D", items=(4,)),
        Rule("Transferencias", "Impuestos y Transferencias", "D", items=(5,)),
        Rule("Resultado", "Resultado", "H"),
        Rule("Variación de Stocks", "Inversiones", "F", items=(3,), entity=stock_entity),
        Rule("Formación de Capital", "Inversiones", "F"),
    )


# ---------------------------------------------------------------------------
# Monetary methodology
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class MeasureColumns:
    nominal: str
    constant: str
    usd: str
    pct_gdp: str


@dataclass(frozen=True)
class MonetaryMethodology:
    """Base year of the price index, projection year, naming and growth."""

    base_year: int = 2024
    projection_year: int = 2025
    first_year: int = 2020
    gdp_growth_for_projection: float = 0.025
    annual: MeasureColumns = MeasureColumns("valor", "valor_2024", "valor_usd", "valor_pct_pib")
    projection: MeasureColumns = MeasureColumns("ejecutado", "ejecutado_2024", "ejecutado_usd",
                                                "ejecutado_pct_pib")
    index_series: str = "ipc_anual"
    gdp_series: str = "pib_nominal_anual"
    rate_series: str = "dolar_promedio_anual"
    index_value: str = "ipc_base_24"
    gdp_value: str = "pib_nominal"
    rate_value: str = "dolar_promedio"
    unit_labels: tuple[tuple[str, str], ...] = (
        ("Millones de $ corr.", "nominal"),
        ("Millones de $ ctes. 2024", "constant"),
        ("Millones de USD", "usd"),
        ("% del PIB", "pct_gdp"),
    )

    def unit_choices(self, scope: str = "annual") -> dict[str, str]:
        cols = self.annual if scope == "annual" else self.projection
        if scope not in ("annual", "projection"):
            raise ValueError(f"unknown scope {scope!r}")
        return {label: getattr(cols, key) for label, key in self.unit_labels}

    def constant_unit_label(self) -> str:
        for label, key in self.unit_labels:
            if key == "constant":
                return label
        raise KeyError("constant")


DEFAULT_METHODOLOGY = MonetaryMethodology()


# ---------------------------------------------------------------------------
# Cash configuration
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class CashConfig:
    income_class: tuple[str, ...] = CASH_INCOME_CLASS
    expense_class: tuple[str, ...] = CASH_EXPENSE_CLASS
    opening_overrides: dict[str, float] = field(default_factory=lambda: dict(CASH_OPENING_OVERRIDES))
    expense_minimums: dict[str, float] = field(default_factory=lambda: dict(CASH_EXPENSE_MINIMUMS))
    movement_account: tuple[str, int, int] = ("I", 5, 1)
    income_account: str = "A"


DEFAULT_CASH = CashConfig()
