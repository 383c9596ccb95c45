"""Column builders: every function returns a ``Column`` (JVM-side, codegen)."""

from ledgerlake.functions.dates import (first_of_month, month_label, month_number, parse_date,
                                        serial_to_date, year_token)
from ledgerlake.functions.display import format_amount, format_money, format_percent, month_year_label, panel_title
from ledgerlake.functions.lookup import code_lookup, ordinal
from ledgerlake.functions.numeric import is_finite, lenient_double
from ledgerlake.functions.text import blank, canonical_label, squish, tidy_columns, tidy_name

__all__ = [
    "tidy_name", "tidy_columns", "squish", "canonical_label", "blank",
    "month_number", "first_of_month", "serial_to_date", "parse_date", "year_token", "month_label",
    "lenient_double", "is_finite",
    "code_lookup", "ordinal",
    "format_amount", "format_money", "format_percent", "month_year_label", "panel_title",
]
