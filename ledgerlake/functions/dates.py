"""Date columns (PRJ-06..PRJ-11, PRJ-22)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType

from ledgerlake.config import DATE_FORMATS, MONTH_LABELS, MONTH_SHEETS, SERIAL_ORIGIN, YEAR_TOKEN_PATTERN
from ledgerlake.functions._util import col
from ledgerlake.functions.lookup import ordinal
from ledgerlake.functions.numeric import lenient_double


SERIAL_DAYS_BEFORE, SERIAL_DAYS_AFTER = 693_593, 2_958_465


def month_number(c, vocabulary: Sequence[str] = MONTH_SHEETS) -> Column:
    """Month token -> 1..12 by position in ``vocabulary``; unknown -> NULL."""
    return ordinal(c, vocabulary)


def first_of_month(year, month) -> Column:
    """DATE of the first day of (year, month)."""
    return F.make_date(col(year).cast("int"), col(month).cast("int"), F.lit(1))


def serial_to_date(c) -> Column:
    """Spreadsheet serial day number (text or number) -> DATE; junk, and
    numbers beyond the calendar (years 1 to 9999), -> NULL."""
    days = F.floor(lenient_double(col(c).cast("string")))
    valid = days.between(-SERIAL_DAYS_BEFORE, SERIAL_DAYS_AFTER)
    return F.date_add(F.lit(SERIAL_ORIGIN).cast("date"), F.when(valid, days).cast("int"))


def _format_regex(fmt: str) -> str | None:
    """Regex accepting exactly the digit layouts a numeric date pattern can
    parse (``d``, ``dd``, ``M``, ``MM``, ``yyyy`` and literal separators);
    None for patterns with other letters."""
    out, i = [], 0
    while i < len(fmt):
        ch = fmt[i]
        j = i
        while j < len(fmt) and fmt[j] == ch:
            j += 1
        run = j - i
        if ch in "dM" and run <= 2:
            out.append(r"\d{1,2}" if run == 1 else r"\d{2}")
        elif ch == "y" and run in (2, 4):
            out.append(r"\d{%d}" % run)
        elif ch.isalpha() or ch == "'":
            return None
        else:
            out.append(re.escape(fmt[i:j]))
        i = j
    return "^" + "".join(out)


def _try_format(text: Column, fmt: str) -> Column:
    """``try_to_date`` of the leading part that has the format's shape (text
    after it, such as a time, is ignored), so rows never pay for a failed
    parse of a format they cannot match."""
    rx = _format_regex(fmt)
    if rx is None:
        return F.try_to_date(text, fmt)
    return F.when(text.rlike(rx), F.try_to_date(F.regexp_extract(text, rx, 0), fmt))


def parse_date(c, formats: Sequence[str] = DATE_FORMATS, dtype=StringType()) -> Column:
    """Date / timestamp pass through; text is trimmed and tried per format.

    The per-row ``coalesce`` accepts a column that mixes formats (more lenient
    than choosing one format per column; see
    :func:`ledgerlake.operators.periods.parse_dates_uniform` for that).
    """
    x = col(c)
    if isinstance(dtype, DateType):
        return x
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return F.to_date(x)
    text = F.trim(x.cast("string"))
    return F.coalesce(*[_try_format(text, fmt) for fmt in formats])


def year_token(c) -> Column:
    """First four-digit run (an optional trailing ``*`` marks provisional) -> int."""
    return F.regexp_extract(col(c), YEAR_TOKEN_PATTERN, 1).try_cast("int")


def month_label(month, labels: Sequence[str] = MONTH_LABELS) -> Column:
    """1..12 -> locale-free short month label; other values -> NULL."""
    m = col(month).cast("int")
    arr = F.array(*[F.lit(v) for v in labels])
    return F.when(m.between(1, len(labels)), F.element_at(arr, m))
