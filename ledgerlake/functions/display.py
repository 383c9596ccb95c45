"""Display strings (PRJ-21, PRJ-22, PRJ-23).

Amounts are shown in millions with ``.`` for thousands and ``,`` for decimals.
The number of decimals is a fixed argument rather than chosen per vector.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ledgerlake.config import DISPLAY_UNITS, FACET_TITLES
from ledgerlake.functions._util import col
from ledgerlake.functions.dates import month_label
from ledgerlake.functions.lookup import code_lookup


def _localized(magnitude: Column, decimals: int) -> Column:
    return F.translate(F.format_number(magnitude, decimals), ",.", ".,")


def format_money(c, prefix: str = "$ ", scale: float = 1e-6, decimals: int = 0) -> Column:
    """e.g. -1234567890 -> ``-$ 1.235`` (millions, rounded half away from zero)."""
    x = col(c)
    mag = F.round(F.abs(x) * F.lit(scale), decimals)
    sign = F.when(x < 0, F.lit("-")).otherwise(F.lit(""))
    return F.when(x.isNotNull(), F.concat(sign, F.lit(prefix), _localized(mag, decimals)))


def format_percent(c, decimals: int = 2) -> Column:
    """Share -> ``12,34%``."""
    x = col(c)
    mag = F.round(F.abs(x) * F.lit(100.0), decimals)
    sign = F.when(x < 0, F.lit("-")).otherwise(F.lit(""))
    return F.when(x.isNotNull(), F.concat(sign, _localized(mag, decimals), F.lit("%")))


def format_amount(c, unit: str, units=None) -> Column:
    """Format by measure column name (``units``: name -> (kind, prefix));
    an unknown unit leaves the value as text."""
    kind = (units or DISPLAY_UNITS).get(unit)
    if kind is None:
        return col(c).cast("string")
    if kind[0] == "percent":
        return format_percent(c)
    return format_money(c, prefix=kind[1])


def month_year_label(date) -> Column:
    """``Ene 2025`` style label of a date."""
    d = col(date)
    return F.concat_ws(" ", month_label(F.month(d)), F.year(d).cast("string"))


def panel_title(entity, facet, year) -> Column:
    """``<entity> - <facet title>[ <year>]``; the year part is blank when NULL."""
    y = col(year)
    suffix = F.when(y.isNotNull(), F.concat(F.lit(" "), y.cast("string"))).otherwise(F.lit(""))
    return F.concat(col(entity), F.lit(" - "), code_lookup(facet, FACET_TITLES), suffix)
