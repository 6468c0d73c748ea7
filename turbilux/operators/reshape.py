"""Long <-> wide, border copies, unions and order."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turbilux.functions.geometry import border_flag
from turbilux.site import BORDER_FUDGE, TRACK_BREAKS, ZONE_BREAKS


def pivot_loggers(
    df: DataFrame,
    ids: Sequence[str | Column],
    values: Sequence[str],
    *,
    names_from: str = "logger_number_per_pole",
    numbers: Sequence[int] = (1, 2, 3),
    cell: str = "single",
    extra: Sequence[Column] = (),
) -> DataFrame:
    """One row per ``ids``; each value becomes ``<value>_<number>``, NULL where absent.

    Columns ``n_<number>`` hold the cell's row count.  ``cell="single"`` fails the job
    on a cell with more than one row, ``cell="mean"`` averages it.  The work is one
    aggregation with partial sums before its shuffle.
    """
    if cell not in ("single", "mean"):
        raise ValueError("cell must be 'single' or 'mean'")
    fold = F.max if cell == "single" else F.avg
    number = F.col(names_from)
    aggs = [
        fold(F.when(number == n, F.col(v))).alias(f"{v}_{n}") for v in values for n in numbers
    ]
    counts = [F.count(F.when(number == n, F.lit(1))).alias(f"n_{n}") for n in numbers]
    wide = df.groupBy(*ids).agg(*aggs, *counts, *extra)
    if cell == "single":
        crowded = reduce(or_, (F.col(f"n_{n}") > 1 for n in numbers))
        failure = F.raise_error(F.lit("more than one row for a pole and logger number")).cast("boolean")
        wide = wide.filter(F.when(crowded, failure).otherwise(True))
    return wide


def unpivot_loggers(
    df: DataFrame,
    values: Sequence[str],
    *,
    numbers: Sequence[int] = (1, 2),
    id_name: str = "logger_id",
) -> DataFrame:
    """``<value>_<number>`` columns to one row per logger; the inverse of the pivot."""
    wide = {f"{v}_{n}" for v in values for n in numbers}
    kept = [c for c in df.columns if c not in wide]
    loggers = F.array(
        *(
            F.struct(F.lit(str(n)).alias(id_name), *(F.col(f"{v}_{n}").alias(v) for v in values))
            for n in numbers
        )
    )
    return df.select(*kept, F.explode(loggers).alias("_logger")).select(*kept, "_logger.*")


def split_on_border(
    df: DataFrame,
    coordinate: str,
    borders: Sequence[float],
    fudge: float = BORDER_FUDGE,
    shift: float | None = None,
) -> DataFrame:
    """Rows on a border become two, shifted down and up; all others stay as they are."""
    shift = fudge if shift is None else shift
    v = F.col(coordinate)
    both = F.array(v - F.lit(shift), v + F.lit(shift))
    places = F.when(border_flag(v, borders, fudge), both).otherwise(F.array(v))
    others = [F.col(c) for c in df.columns if c != coordinate]
    return df.select(*others, F.explode(places).alias(coordinate)).select(*df.columns)


def split_on_borders(df: DataFrame, fudge: float = BORDER_FUDGE, shift: float | None = None) -> DataFrame:
    """First on x, then on y: a pole on a corner gives four rows."""
    return split_on_border(
        split_on_border(df, "coord_x", TRACK_BREAKS, fudge, shift), "coord_y", ZONE_BREAKS, fudge, shift
    )


def bind_rows(*frames: DataFrame) -> DataFrame:
    """Union by name; duplicates stay, missing columns are NULL."""
    first, *rest = frames
    for other in rest:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def arrange(df: DataFrame, *columns: str | Column) -> DataFrame:
    """Range-partitioned total sort, missing values last."""
    keys = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in columns]
    return df.orderBy(*keys)
