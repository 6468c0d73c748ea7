"""Sums, means and deviations of doubles that do not depend on the order of the rows.

Doubles added in another order end in other last bits, so a plain sum differs between partitionings, cluster sizes and
repeated tasks.  Here every value is cut into two whole numbers inside a bin of exponents.  Whole numbers add up exactly in
any order, and the few bins of a group are put together from the smallest up.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turbilux.functions.missing import nan_to_null

# powers of two in a bin, and bits behind the point of a value that is scaled to its bin
BIN_BITS = 32
FRACTION_BITS = 53

_ENDLESS = float("inf")


def _power(bins: Column, sign: int) -> Column:
    """Half of the way to a bin: twice this factor stays inside the range of doubles."""
    return F.pow(F.lit(2.0), bins * F.lit(sign * BIN_BITS // 2))


def _null_safe(left: DataFrame, right: DataFrame, by: Sequence[str], how: str) -> DataFrame:
    """Join on ``by`` where NULL keys meet; the columns of the right side's keys go."""
    named = right.select(*(F.col(c).alias(f"_right_{c}") for c in by), *(c for c in right.columns if c not in by))
    same = [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in by]
    return left.join(named, same, how).drop(*(f"_right_{c}" for c in by))


def order_free_sums(
    df: DataFrame, by: Sequence[str], values: Mapping[str, Column], wholes: Mapping[str, Column] | None = None
) -> DataFrame:
    """One row per group: ``by``, the ``wholes`` (sums of integers), and for each value ``<name>_n`` and ``<name>_sum``.

    NULL and NaN are skipped; a group without a value has the sum NULL.  Infinite values make the sum infinite, or NULL if
    both signs occur.  A group has at most 66 bins a value, so its state stays small and is pre-aggregated however many rows
    it has.  The result is the same to the last bit for any partitioning of the rows.
    """
    wholes = dict(wholes or {})
    # a group without values to sum still has its wholes
    entries = [
        F.struct(F.lit(i).alias("_which"), nan_to_null(v.cast("double")).alias("_x")) for i, v in enumerate(values.values())
    ]
    counted = [F.when(F.col("_e._which") == 0, F.col(f"_whole_{i}")).alias(f"_whole_{i}") for i in range(len(wholes))]
    melted = df.select(
        *by, *(w.alias(f"_whole_{i}") for i, w in enumerate(wholes.values())), F.explode(F.array(*entries)).alias("_e")
    ).select(*by, *counted, "_e._which", "_e._x")
    finite = (F.abs("_x") < _ENDLESS) & (F.col("_x") != 0)
    binned = melted.withColumn("_bin", F.when(finite, F.floor(F.log2(F.abs("_x")) / BIN_BITS)))
    # scaled by a power of two: exact, and all bits stand at or above the last place of the fraction
    scaled = F.col("_x") * _power(F.col("_bin"), -1) * _power(F.col("_bin"), -1)
    binned = binned.withColumn("_scaled", F.when(F.col("_bin").isNotNull(), scaled))
    whole = F.col("_scaled").cast("bigint")
    rest = ((F.col("_scaled") - whole.cast("double")) * float(2**FRACTION_BITS)).cast("bigint")
    bins = binned.groupBy(*by, "_which", "_bin").agg(
        F.sum(whole.cast("decimal(20,0)")).alias("_high"),
        F.sum(rest.cast("decimal(20,0)")).alias("_low"),
        F.count("_x").alias("_n"),
        F.count(F.when(F.col("_x") == _ENDLESS, 1)).alias("_up"),
        F.count(F.when(F.col("_x") == -_ENDLESS, 1)).alias("_down"),
        *(F.sum(f"_whole_{i}").alias(f"_whole_{i}") for i in range(len(wholes))),
    )

    def of(i: int, c: str) -> Column:
        return F.when(F.col("_which") == i, F.col(c))

    parts = [
        (
            F.sum(of(i, "_n")).alias(f"_n_{i}"),
            F.sum(of(i, "_up")).alias(f"_up_{i}"),
            F.sum(of(i, "_down")).alias(f"_down_{i}"),
            F.collect_list(F.when((F.col("_which") == i) & F.col("_bin").isNotNull(), F.struct("_bin", "_high", "_low"))).alias(
                f"_bins_{i}"
            ),
        )
        for i in range(len(values))
    ]
    groups = bins.groupBy(*by).agg(
        *(F.sum(f"_whole_{i}").alias(name) for i, name in enumerate(wholes)), *(c for part in parts for c in part)
    )

    def total(i: int) -> Column:
        def add(so_far: Column, part: Column) -> Column:
            value = part["_high"].cast("double") + part["_low"].cast("double") / float(2**FRACTION_BITS)
            return so_far + value * _power(part["_bin"], 1) * _power(part["_bin"], 1)

        up, down = F.col(f"_up_{i}") > 0, F.col(f"_down_{i}") > 0
        return (
            F.when((F.col(f"_n_{i}") == 0) | (up & down), F.lit(None).cast("double"))
            .when(up, F.lit(_ENDLESS))
            .when(down, F.lit(-_ENDLESS))
            .otherwise(F.aggregate(F.array_sort(f"_bins_{i}"), F.lit(0.0), add))
        )

    sums = [c for i, name in enumerate(values) for c in (F.col(f"_n_{i}").alias(f"{name}_n"), total(i).alias(f"{name}_sum"))]
    return groups.select(*by, *wholes, *sums)


def order_free_stats(
    df: DataFrame,
    by: Sequence[str],
    *,
    means: Mapping[str, str] | None = None,
    sds: Mapping[str, str] | None = None,
    sums: Mapping[str, str] | None = None,
    wholes: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Group statistics that are equal to the last bit on any cluster; each argument maps a new column to what it is taken of.

    ``sds`` are sample deviations (NULL below two values or with an infinite one), from a second pass over the squares of the
    distances to the mean.  ``wholes`` are sums of integers, which need no care.  NULL keys form groups of their own.
    """
    if not by:
        raise ValueError("name at least one column to group by")
    means, sds, sums = dict(means or {}), dict(sds or {}), dict(sums or {})
    columns = list(dict.fromkeys([*means.values(), *sds.values(), *sums.values()]))
    name = {c: f"_v{i}" for i, c in enumerate(columns)}

    def mean(c: str) -> Column:
        return F.try_divide(F.col(f"{name[c]}_sum"), F.col(f"{name[c]}_n"))

    groups = order_free_sums(df, by, {name[c]: F.col(c) for c in columns}, wholes)
    spread = list(dict.fromkeys(sds.values()))
    if spread:
        centres = groups.select(*by, *(F.when(F.abs(mean(c)) < _ENDLESS, mean(c)).alias(f"_mean{name[c]}") for c in spread))
        apart = {f"_q{name[c]}": (F.col(c).cast("double") - F.col(f"_mean{name[c]}")) for c in spread}
        squares = order_free_sums(_null_safe(df, centres, by, "inner"), by, {q: d * d for q, d in apart.items()})
        groups = _null_safe(groups, squares, by, "inner")

    def sd(c: str) -> Column:
        q = f"_q{name[c]}"
        return F.when(F.col(f"{q}_n") > 1, F.sqrt(F.col(f"{q}_sum") / (F.col(f"{q}_n") - 1)))

    return groups.select(
        *by,
        *(mean(c).alias(out) for out, c in means.items()),
        *(sd(c).alias(out) for out, c in sds.items()),
        *(F.col(f"{name[c]}_sum").alias(out) for out, c in sums.items()),
        *(wholes or {}),
    )
