"""Places of rows in an order over the whole frame, without one task that holds them all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# ranges the keys are cut into, and the hashed keys per range that choose the cuts
RANGES = 256
KEYS_PER_RANGE = 20


def ordering(columns: Sequence[str], missing_last: bool = True) -> Column:
    """One value that sorts like the columns one after the other, missing values last (or first)."""
    flag = F.isnull if missing_last else F.isnotnull
    parts = []
    for i, c in enumerate(columns):
        parts += [flag(c).alias(f"m{i}"), F.col(c).alias(f"v{i}")]
    return F.struct(*parts)


def _cuts(keys: DataFrame, columns: Sequence[str], ranges: int) -> list[Column]:
    """At most ``ranges`` - 1 of the keys, as literals: every so many of a set chosen by hash.

    They travel as text.  A cut that lost digits on the way serves as well, since all rows are compared with the same cuts.
    """
    kinds = dict(keys.dtypes)
    chosen = keys.orderBy(F.xxhash64("_place"), "_place").limit(ranges * KEYS_PER_RANGE).orderBy("_place")
    rows = chosen.select(*(F.col(c).cast("string") for c in columns), *(F.col(f"_place.m{i}") for i in range(len(columns)))).collect()
    step = max(1, -(-len(rows) // ranges))
    out = []
    for row in rows[step::step]:
        parts = []
        for i, c in enumerate(columns):
            parts += [F.lit(row[len(columns) + i]).alias(f"m{i}"), F.lit(row[i]).cast(kinds[c]).alias(f"v{i}")]
        out.append(F.struct(*parts))
    return out


def ranked(
    df: DataFrame, columns: Sequence[str], name: str = "rank", *, missing_last: bool = True, ranges: int = RANGES
) -> DataFrame:
    """Adds each row's place (from 1) in the order of ``columns``; rows with equal keys share the first of their places.

    Keys are counted first, so rows that repeat a key are one row from there on.  Cuts chosen once, and at most
    ``ranges`` x 20 keys on the driver for it, deal the keys into ranges by comparison: a range is the same
    however often Spark computes it.  Inside a range counts are added up in order; the totals of the ranges give where
    each begins.
    """
    placed = df.withColumn("_place", ordering(columns, missing_last))
    keys = placed.groupBy("_place", *columns).agg(F.count(F.lit(1)).alias("_n"))
    cuts = _cuts(keys, columns, ranges)
    range_ = F.size(F.filter(F.array(*cuts), lambda cut: cut <= F.col("_place"))) if cuts else F.lit(0)
    dealt = keys.select("_place", "_n", range_.alias("_range"))
    inside = Window.partitionBy("_range").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range
    totals = dealt.groupBy("_range").agg(F.sum("_n").alias("_total"))
    begins = totals.select("_range", F.coalesce(F.sum("_total").over(ahead), F.lit(0)).alias("_begin"))
    place = F.col("_begin") + F.coalesce(F.sum("_n").over(inside), F.lit(0)) + 1
    ranks = dealt.join(begins, "_range").select("_place", place.alias(name))
    return placed.join(ranks, "_place").drop("_place")
