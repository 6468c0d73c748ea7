"""Centred rolling means over a sample series."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 65_536


# row numbers are divided by k in steps of 2^-30; this many stay below half a row for any k up to 10^8
_STEP_BITS = 30
_MARGIN = 2


def centered_rolling_mean(
    df: DataFrame,
    values: Sequence[str],
    k: int | str,
    *,
    by: Sequence[str],
    order: Sequence[str],
    suffix: str = "_rollmean",
    names: Sequence[str] | None = None,
) -> DataFrame:
    """Adds ``<value><suffix>``: the mean of k rows around each row, NULL near the ends.

    ``k`` is a number or the name of an integer column that is the same in all rows of a series; where it is NULL or less
    than 1 there is no mean.  The series is cut into stretches of k rows.  A window covers the end of one stretch and the
    beginning of the next, so its sum is one running sum from behind plus one from the front.  Only values of the window are
    added and nothing is subtracted: a large value leaves no trace once the window has passed it, and work does not depend
    on k.  Every series is sorted within one task: use it where a series' length is known to be moderate, and
    ``blocked_rolling_mean`` otherwise.
    """
    names = list(names) if names else [f"{v}{suffix}" for v in values]
    kept = df.columns
    row = F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long")
    width = F.coalesce(F.col("_width"), F.lit(1))
    df = (
        df.withColumns({"_width": _width(k), "_row": row})
        .withColumn("_stretch", F.floor((F.col("_row") - 1) / width))
        .withColumn("_steps", F.floor(F.shiftleft("_row", _STEP_BITS) / width))
    )
    stretch = Window.partitionBy(*by, "_stretch")
    front = stretch.orderBy("_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    behind = stretch.orderBy(F.col("_row").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for i, v in enumerate(values):
        value = F.when(~F.isnan(v), F.col(v).cast("double"))
        parts = {"n": F.count(value), "sum": F.sum(value)}
        df = df.withColumns(
            {f"_{name}_{side}_{i}": part.over(w) for name, part in parts.items() for side, w in (("front", front), ("behind", behind))}
        )
    # an even window reaches one row further ahead, so both ends lie just after -1/2 and +1/2 of a width
    half = 1 << (_STEP_BITS - 1)
    series = Window.partitionBy(*by).orderBy("_steps")
    last = series.rangeBetween(Window.unboundedPreceding, half + _MARGIN)
    before = series.rangeBetween(Window.unboundedPreceding, -half + _MARGIN)
    opening = series.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = [f"_{name}_behind_{i}" for i in range(len(values)) for name in ("n", "sum")]
    # the window begins one row after the last row before it, or with the series
    heads = F.struct("_row", "_stretch", *sums)
    df = df.withColumn("_head", heads).withColumn("_next", F.lead("_head").over(series))
    tail = F.struct("_row", "_stretch", *(f"_{name}_front_{i}" for i in range(len(values)) for name in ("n", "sum")))
    df = df.withColumns(
        {
            "_first": F.coalesce(F.last("_next").over(before), F.first("_head").over(opening)),
            "_last": F.last(tail).over(last),
        }
    )
    # a window cut off by an end of the series has fewer rows
    whole = F.col("_last._row") - F.col("_first._row") + 1 == F.col("_width")
    split = F.col("_first._stretch") < F.col("_last._stretch")
    means = {}
    for i, name in enumerate(names):
        total = [
            F.when(split, F.coalesce(F.col(f"_first._{part}_behind_{i}"), F.lit(0))).otherwise(F.lit(0))
            + F.coalesce(F.col(f"_last._{part}_front_{i}"), F.lit(0))
            for part in ("n", "sum")
        ]
        means[name] = F.when(whole & (total[0] == F.col("_width")), total[1] / total[0])
    return df.withColumns(means).select(*kept, *names)


def _width(k: int | str) -> Column:
    width = F.lit(k) if isinstance(k, int) else F.col(k).cast("int")
    return F.when(width >= 1, width)


def series_positions(df: DataFrame, by: Sequence[str], order: Sequence[str], chunk: Column) -> DataFrame:
    """Adds ``_position``, the 0-based row number in the series, without sorting a whole
    series in one task: ``chunk`` grows with ``order`` and cuts the series into pieces.
    """
    by = list(by)
    # rows without an order come first, as in a sort
    pieces = df.withColumn("_chunk", F.coalesce(chunk.cast("long"), F.lit(-(2**62))))
    ahead = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        pieces.groupBy(*by, "_chunk")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*by, "_chunk", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy(*by, "_chunk").orderBy(*order)
    keys = [*by, "_chunk"]
    offsets = offsets.select(*(F.col(c).alias(f"_at_{i}") for i, c in enumerate(keys)), "_offset")
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_at_{i}")) for i, c in enumerate(keys)))
    return (
        pieces.withColumn("_row", F.row_number().over(inside))
        .join(offsets, same)
        .drop(*(f"_at_{i}" for i in range(len(keys))))
        .withColumn("_position", F.col("_offset") + F.col("_row") - 1)
        .drop("_chunk", "_row", "_offset")
    )


def blocked_rolling_mean(
    df: DataFrame,
    values: Sequence[str],
    k: int | str,
    *,
    by: Sequence[str],
    order: Sequence[str],
    chunk: Column,
    block_rows: int = BLOCK_ROWS,
    suffix: str = "_rollmean",
    names: Sequence[str] | None = None,
) -> DataFrame:
    """``centered_rolling_mean`` for series of any length.

    Rows are numbered, cut into blocks of ``block_rows`` and copied to the neighbour
    block where a window reaches over the cut; each block is then an ordinary series.
    Copies leave after the window, so every row returns exactly once.
    """
    width = F.coalesce(_width(k), F.lit(1))
    # an even window reaches one row further ahead
    before, after = F.floor((width - 1) / 2), F.floor(width / 2)
    rows = F.greatest(F.lit(block_rows), width)
    position = F.col("_position")
    reached = F.sequence(
        F.floor(F.greatest(position - after, F.lit(0)) / rows), F.floor((position + before) / rows)
    )
    copies = (
        series_positions(df, by, order, chunk)
        .withColumn("_home", F.floor(position / rows))
        .withColumn("_block", F.explode(reached))
    )
    rolled = centered_rolling_mean(
        copies, values, k, by=[*by, "_block"], order=["_position"], suffix=suffix, names=names
    )
    return rolled.filter(F.col("_block") == F.col("_home")).drop("_position", "_home", "_block")
