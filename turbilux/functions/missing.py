"""Missing values: NULL and NaN are one and the same to the analyst."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from turbilux.site import NA_TOKENS


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: Column | str) -> Column:
    """NaN becomes NULL, so that avg/stddev/filters skip it; infinities stay."""
    c = as_column(c)
    return F.when(~F.isnan(c), c)


def present(c: Column | str) -> Column:
    """Neither NULL nor (for floating values) NaN."""
    return as_column(c).isNotNull()


def present_number(c: Column | str) -> Column:
    c = as_column(c)
    return c.isNotNull() & ~F.isnan(c)


def na_tokens_to_null(c: Column | str, tokens: tuple[str, ...] = NA_TOKENS) -> Column:
    """Trimmed text, with the sheet's spellings of "missing" as NULL."""
    text = F.trim(as_column(c))
    return F.when(~text.isin(*tokens), text)
