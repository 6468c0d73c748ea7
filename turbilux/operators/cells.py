"""Roll-ups of attenuation over the site grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turbilux.functions.geometry import snap_to, tile_bounds, track_of, zone_of
from turbilux.functions.missing import nan_to_null
from turbilux.operators.exact_sums import order_free_stats
from turbilux.site import TRACK_BREAKS, TRACK_LEVELS, ZONE_BREAKS, ZONE_LEVELS

CELL = ("date", "disturbance_number", "track", "zone")
DAY = ("date", "track", "zone")
PLACE = ("track", "zone")


def mean_of(c: str):
    return nan_to_null(F.avg(nan_to_null(c)))


def sum_of(c: str):
    return nan_to_null(F.sum(nan_to_null(c)))


def _sd(c: str):
    return nan_to_null(F.stddev_samp(nan_to_null(c)))


def classify(df: DataFrame) -> DataFrame:
    """Adds ``track`` and ``zone`` from the coordinates."""
    return df.withColumns({"track": track_of("coord_x"), "zone": zone_of("coord_y")})


def cell_stats(
    poles: DataFrame,
    by: Sequence[str] = CELL,
    value: str = "light_attenuation_mean",
    min_mean: float | None = 0.0,
    order_free: bool = False,
) -> DataFrame:
    """Mean, sample sd, rows and sum per cell; cells below ``min_mean`` go (None keeps all).

    With ``order_free``, here and in the roll-ups below, equal bits come out on any cluster (``exact_sums``).
    """
    if order_free:
        stats = order_free_stats(
            poles,
            by,
            means={"mean_light_attenuation": value},
            sds={"sd_light_attenuation": value},
            sums={"sum_light_attenuation": value},
            wholes={"n": F.lit(1)},
        ).select(*by, "mean_light_attenuation", "sd_light_attenuation", "n", "sum_light_attenuation")
    else:
        stats = poles.groupBy(*by).agg(
            mean_of(value).alias("mean_light_attenuation"),
            _sd(value).alias("sd_light_attenuation"),
            F.count(F.lit(1)).alias("n"),
            sum_of(value).alias("sum_light_attenuation"),
        )
    return stats if min_mean is None else stats.filter(F.col("mean_light_attenuation") >= min_mean)


# what the roll-ups of cells take the mean and the sd of
_MEAN = {"mean_light_attenuation": "mean_light_attenuation"}
_SD = {"sd_light_attenuation": "sd_light_attenuation"}


def day_mean(cells: DataFrame, order_free: bool = False) -> DataFrame:
    """Mean of cell means, sd of cell sds, ``n`` = number of cells."""
    if order_free:
        return order_free_stats(cells, DAY, means=_MEAN, sds=_SD, wholes={"n": F.lit(1)})
    return cells.groupBy(*DAY).agg(
        mean_of("mean_light_attenuation").alias("mean_light_attenuation"),
        _sd("sd_light_attenuation").alias("sd_light_attenuation"),
        F.count(F.lit(1)).alias("n"),
    )


def day_sum(cells: DataFrame, order_free: bool = False) -> DataFrame:
    """As ``day_mean``, but ``n`` and the sums add up over the cells."""
    if order_free:
        total = {"sum_light_attenuation": "sum_light_attenuation"}
        return order_free_stats(cells, DAY, means=_MEAN, sds=_SD, sums=total, wholes={"n": F.col("n")})
    return cells.groupBy(*DAY).agg(
        mean_of("mean_light_attenuation").alias("mean_light_attenuation"),
        _sd("sd_light_attenuation").alias("sd_light_attenuation"),
        F.sum("n").alias("n"),
        sum_of("sum_light_attenuation").alias("sum_light_attenuation"),
    )


def experiment_mean(cells: DataFrame, order_free: bool = False) -> DataFrame:
    """Per day first, then over the days: mean of means and sd of sds, both times."""
    if order_free:
        return order_free_stats(day_mean(cells, order_free=True), PLACE, means=_MEAN, sds=_SD)
    return (
        day_mean(cells)
        .groupBy(*PLACE)
        .agg(
            mean_of("mean_light_attenuation").alias("mean_light_attenuation"),
            _sd("sd_light_attenuation").alias("sd_light_attenuation"),
        )
    )


def replicate_mean(trials: DataFrame, by: Sequence[str] = ("point_name", "date", "disturbance_number")) -> DataFrame:
    """Mean over repeated trial rows of a pole."""
    return trials.groupBy(*by).agg(mean_of("light_attenuation_mean").alias("light_attenuation_mean"))


def global_range(trials: DataFrame, value: str = "light_attenuation_mean") -> DataFrame:
    v = nan_to_null(value)
    return trials.agg(F.min(v).alias("min_attenuation"), F.max(v).alias("max_attenuation"))


def count_by_snapped(poles: DataFrame, step: float = 100.0) -> DataFrame:
    """Poles per coordinate rounded to the step."""
    return poles.groupBy(
        snap_to("coord_x", step).alias("coord_x"), snap_to("coord_y", step).alias("coord_y")
    ).agg(F.count(F.lit(1)).alias("n"))


def _intervals_holding(coordinate: str, breaks: Sequence[float]):
    """1-based numbers of the closed intervals that hold the value (two on an inner break)."""
    v = F.col(coordinate)
    return F.array_compact(
        F.array(*(F.when(v.between(lo, hi), F.lit(i)) for i, (lo, hi) in enumerate(zip(breaks, breaks[1:]), 1)))
    )


def points_in_cells(
    poles: DataFrame,
    x_breaks: Sequence[float] = TRACK_BREAKS,
    y_breaks: Sequence[float] = ZONE_BREAKS,
) -> DataFrame:
    """Poles per cell with inclusive borders, empty cells as zero.

    Each pole names its (at most four) cells itself, so the count is one aggregation;
    the grid's zero rows are added to it before, not joined.
    """
    hits = poles.select(F.explode(_intervals_holding("coord_x", x_breaks)).alias("x"), "coord_y").select(
        "x", F.explode(_intervals_holding("coord_y", y_breaks)).alias("y"), F.lit(1).alias("hit")
    )
    numbers = [F.sequence(F.lit(1), F.lit(len(b) - 1)) for b in (x_breaks, y_breaks)]
    empty = (
        poles.sparkSession.range(1)
        .select(F.explode(numbers[0]).alias("x"))
        .select("x", F.explode(numbers[1]).alias("y"), F.lit(0).alias("hit"))
    )
    return hits.unionByName(empty).groupBy("x", "y").agg(F.sum("hit").alias("cnt"))


def grid(spark, tracks: Sequence[str] = TRACK_LEVELS, zones: Sequence[str] = ZONE_LEVELS) -> DataFrame:
    """Every track with every zone."""
    return spark.range(1).select(F.explode(F.array(*(F.lit(t) for t in tracks))).alias("track")).select(
        "track", F.explode(F.array(*(F.lit(z) for z in zones))).alias("zone")
    )


def with_tile_bounds(df: DataFrame) -> DataFrame:
    return df.select("*", *tile_bounds())
