"""Upper and lower logger of a pole, side by side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turbilux.functions.light import ZERO_LIGHT, attenuation_pct
from turbilux.functions.missing import nan_to_null
from turbilux.operators.reshape import pivot_loggers

SAMPLE_KEYS = ("number", "date_time")


def pair_loggers(
    top: DataFrame,
    bottom: DataFrame,
    keys: Sequence[str] = SAMPLE_KEYS,
    within: Sequence[str] = (),
) -> DataFrame:
    """Inner join of two sample frames on ``within`` + ``keys``; other columns get _1 / _2.

    Sample ordinal and time are part of the key, so even a pole with a large share of
    the data spreads over all tasks.
    """
    shared = [*within, *keys]

    def suffixed(df: DataFrame, n: int) -> DataFrame:
        return df.select(*shared, *(F.col(c).alias(f"{c}_{n}") for c in df.columns if c not in shared))

    return suffixed(top, 1).join(suffixed(bottom, 2), shared, "inner")


def pair_samples(
    samples: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    *,
    role: str = "logger_number",
    cell: str = "single",
    extra: Sequence[Column] = (),
) -> DataFrame:
    """``pair_loggers`` in one scan and one shuffle, for keys unique within a logger.

    ``samples`` holds both loggers, told apart by ``role`` (1 upper, 2 lower).  A key
    that repeats fails the job (``cell="single"``) or is averaged first ("mean").
    """
    both = samples.filter(F.col(role).isin(1, 2))
    wide = pivot_loggers(both, keys, values, names_from=role, numbers=(1, 2), cell=cell, extra=extra)
    return wide.filter((F.col("n_1") > 0) & (F.col("n_2") > 0)).drop("n_1", "n_2")


def pair_all(
    samples: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    *,
    role: str = "logger_number",
    extra: Sequence[Column] = (),
) -> DataFrame:
    """``pair_loggers`` in one scan and one shuffle: every upper with every lower sample of a key.

    A key holds the samples of one ordinal and time, a handful even where they repeat.
    """
    lists = [
        F.collect_list(F.when(F.col(role) == n, F.struct(*(F.col(v).alias(f"{v}_{n}") for v in values)))).alias(f"_side_{n}")
        for n in (1, 2)
    ]
    sides = samples.filter(F.col(role).isin(1, 2)).groupBy(*keys).agg(*lists, *extra)
    others = [c for c in sides.columns if not c.startswith("_side_")]
    one = sides.select(*others, F.explode("_side_1").alias("_one"), "_side_2")
    return one.select(*others, "_one.*", F.explode("_side_2").alias("_two")).select(
        *others, *(f"{v}_1" for v in values), *(F.col(f"_two.{v}_2").alias(f"{v}_2") for v in values)
    )


def mean_attenuation_of_samples(
    samples: DataFrame,
    by: Sequence[str],
    keys: Sequence[str] = SAMPLE_KEYS,
    value: str = "intensity_lum_ft2",
    zero_light: str = "ieee",
    role: str = "logger_number",
) -> DataFrame:
    """``mean_attenuation`` over all pairs of samples that share ``by`` and ``keys``, without making the pairs.

    Samples may repeat: m upper and n lower ones of a key make m n pairs, whose attenuations add up to
    100 (m n - sum(lower) sum(1 / upper)).  Those sums merge, so a key of any size is pre-aggregated.  Pairs on zero light
    and with infinite light are counted apart by sign.  Groups without a pair are left out, as in a natural join.
    """
    if zero_light not in ZERO_LIGHT:
        raise ValueError(f"zero_light must be one of {ZERO_LIGHT}, not {zero_light!r}")
    light = nan_to_null(value).cast("double")
    top, bottom = (F.when(F.col(role) == n, light) for n in (1, 2))
    endless = F.lit(float("inf"))
    base = F.when((F.abs(top) < endless) & (top != 0), top)
    part = F.when(F.abs(bottom) < endless, bottom)

    def count(condition: Column) -> Column:
        return F.count(F.when(condition, F.lit(1)))

    sums = {
        "_rows_1": count(F.col(role) == 1),
        "_rows_2": count(F.col(role) == 2),
        "_above": count(base > 0),
        "_below": count(base < 0),
        "_dark": count(top == 0),
        "_tops": F.sum(base),
        "_inverse": F.sum(1 / base),
        "_parts": F.count(part),
        "_bottoms": F.sum(part),
        "_plus": count(bottom == endless),
        "_minus": count(bottom == -endless),
        "_bright": count(bottom > 0),
        "_negative": count(bottom < 0),
    }
    sides = samples.groupBy(*by, *keys).agg(*(c.alias(name) for name, c in sums.items()))
    m, n = F.col("_above") + F.col("_below"), F.col("_parts")
    # one pair is taken as it is, which spares a rounding
    pct = F.when((m == 1) & (n == 1), 100 * (F.col("_tops") - F.col("_bottoms")) / F.nullif("_tops", F.lit(0.0))).otherwise(
        100 * (m * n - F.col("_bottoms") * F.col("_inverse"))
    )
    down = F.col("_above") * F.col("_plus") + F.col("_below") * F.col("_minus")
    up = F.col("_above") * F.col("_minus") + F.col("_below") * F.col("_plus")
    if zero_light == "ieee":
        down, up = down + F.col("_dark") * F.col("_bright"), up + F.col("_dark") * F.col("_negative")
    total = sides.groupBy(*by).agg(
        F.sum(F.col("_rows_1") * F.col("_rows_2")).alias("_joined"),
        F.sum(m * n).alias("_pairs"),
        F.sum(pct).alias("_pct"),
        F.sum(down).alias("_down"),
        F.sum(up).alias("_up"),
    )
    mean = (
        F.when((F.col("_down") > 0) & (F.col("_up") > 0), F.lit(None).cast("double"))
        .when(F.col("_down") > 0, -endless)
        .when(F.col("_up") > 0, endless)
        .otherwise(F.try_divide(F.col("_pct"), F.col("_pairs")))
    )
    return total.filter(F.col("_joined") > 0).select(*by, mean.alias("light_attenuation_mean"))


def pairing_report(
    samples: DataFrame, within: Sequence[str], keys: Sequence[str] = SAMPLE_KEYS, role: str = "logger_number"
) -> DataFrame:
    """Per group: samples of each logger that found no partner, and pairs."""
    sides = samples.groupBy(*within, *keys).agg(
        F.count(F.when(F.col(role) == 1, 1)).alias("_top"),
        F.count(F.when(F.col(role) == 2, 1)).alias("_bottom"),
    )
    return sides.groupBy(*within).agg(
        F.sum(F.when(F.col("_bottom") == 0, F.col("_top")).otherwise(0)).alias("unpaired_top"),
        F.sum(F.when(F.col("_top") == 0, F.col("_bottom")).otherwise(0)).alias("unpaired_bottom"),
        F.sum(F.col("_top") * F.col("_bottom")).alias("pairs"),
    )


def mean_attenuation(
    pairs: DataFrame,
    by: Sequence[str],
    value: str = "intensity_lum_ft2",
    zero_light: str = "ieee",
) -> DataFrame:
    """Mean over the pairs of the per-sample attenuation; missing samples are skipped."""
    pct = attenuation_pct(f"{value}_1", f"{value}_2", zero_light)
    return pairs.groupBy(*by).agg(nan_to_null(F.avg(pct)).alias("light_attenuation_mean"))


def mean_intensity(samples: DataFrame, by: Sequence[str], value: str = "intensity_lum_ft2") -> DataFrame:
    """Mean light of single loggers in their windows."""
    return samples.groupBy(*by).agg(nan_to_null(F.avg(nan_to_null(value))).alias("mean_intensity"))


def full_outer_pairing(logger_1: DataFrame, logger_2: DataFrame, keys: Sequence[str] = ("point_name", "start_time")) -> DataFrame:
    """Older pairing: poles with only one working logger stay, half filled."""
    one = logger_1.filter(F.col("logger_1_intensity").isNotNull())
    two = logger_2.filter(F.col("logger_2_intensity").isNotNull())
    return one.join(two, list(keys), "full")
