"""The older pole heatmap: ratio of window means, half-filled poles kept."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turbilux.functions.geometry import mirror_x
from turbilux.functions.light import legacy_attenuation
from turbilux.functions.missing import nan_to_null
from turbilux.functions.times import date_of
from turbilux.operators.joins import samples_in_windows


def paired_window_means(
    samples: DataFrame,
    windows: DataFrame,
    on: Sequence[str] = ("file_path",),
    *,
    by: Sequence[str] = ("point_name", "start_time"),
    value: str = "intensity_lum_ft2",
    ts: str = "date_time",
    day: str | None = None,
    bin_seconds: int | None = None,
) -> DataFrame:
    """Mean light of both loggers per pole and window in one aggregation.

    Same rows as a full outer join of the two loggers' means: a pole with one working
    logger stays, a pole with none goes.
    """
    inside = samples_in_windows(samples, windows, on, ts=ts, day=day, bin_seconds=bin_seconds)
    means = [
        nan_to_null(F.avg(F.when(F.col("logger_number") == n, nan_to_null(value)))).alias(f"logger_{n}_intensity")
        for n in (1, 2)
    ]
    wide = inside.groupBy(*by).agg(*means)
    return wide.filter(F.col("logger_1_intensity").isNotNull() | F.col("logger_2_intensity").isNotNull())


def legacy_pole_heatmap(
    paired: DataFrame,
    coords: DataFrame,
    date=None,
    on: Sequence[str] = ("point_name", "date"),
    zero_light: str = "ieee",
) -> DataFrame:
    """Paired means with attenuation, day and mirrored place; all days or one."""
    dated = paired.withColumns(
        {
            "light_attenuation": legacy_attenuation("logger_1_intensity", "logger_2_intensity", zero_light),
            "date": date_of("start_time"),
        }
    )
    if date is not None:
        dated = dated.filter(F.col("date") == F.lit(date).cast("date"))
    return dated.join(coords, list(on), "left").withColumn("map_x", mirror_x("coord_x"))
