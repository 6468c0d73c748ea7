"""Snake-case column names."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPARK_BLANK = re.compile(r"_c\d+")


def clean_name(name: str) -> str:
    text = name.replace("#", " number ").replace("%", " percent ").replace("²", "2")
    text = re.sub(r"[^0-9a-z]+", "_", text.lower()).strip("_")
    if not text:
        return "x"
    return f"x{text}" if text[0].isdigit() else text


def clean_names_of(names: Iterable[str]) -> list[str]:
    """Cleaned names, repeated ones numbered from 2; blank headers become x, x_2, ..."""
    seen: dict[str, int] = {}
    out = []
    for name in names:
        base = "x" if _SPARK_BLANK.fullmatch(name) else clean_name(name)
        seen[base] = seen.get(base, 0) + 1
        out.append(base if seen[base] == 1 else f"{base}_{seen[base]}")
    return out


def clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*clean_names_of(df.columns))


def drop_spill_columns(df: DataFrame) -> DataFrame:
    """Blank-header columns (``x...`` once cleaned) go."""
    return df.drop(*(c for c in df.columns if c.startswith("x")))


def clean_header_field(field: Column) -> Column:
    """``clean_name`` for header text held in a column."""
    text = F.replace(F.replace(F.lower(field), F.lit("#"), F.lit("number")), F.lit("²"), F.lit("2"))
    return F.regexp_replace(F.regexp_replace(text, "[^0-9a-z]+", "_"), "^_+|_+$", "")
