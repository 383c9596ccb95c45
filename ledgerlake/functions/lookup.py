"""Small fixed lookups as map / array literals (PRJ-18, PRJ-19)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, functions as F

from ledgerlake.functions._util import col


def code_lookup(c, mapping: Mapping) -> Column:
    """code -> name through a literal map; unknown or NULL codes give NULL."""
    m = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))
    x = col(c)
    return F.when(x.isNotNull(), F.try_element_at(m, x))


def ordinal(c, levels: Sequence) -> Column:
    """1-based position of the value in ``levels``; values outside give NULL."""
    arr = F.array(*[F.lit(v) for v in levels])
    pos = F.array_position(arr, col(c))
    return F.when(pos > 0, pos.cast("int"))
