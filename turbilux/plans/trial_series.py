"""Every sample of every trial, with rolling means and attenuation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turbilux.functions.geometry import trial_title
from turbilux.functions.light import attenuation_pct, scale_to_axis
from turbilux.functions.times import pad_window
from turbilux.operators.joins import samples_in_windows
from turbilux.operators.pairing import pair_all
from turbilux.operators.reshape import unpivot_loggers
from turbilux.operators.rolling import BLOCK_ROWS, blocked_rolling_mean
from turbilux.plans.pole_trials import LIGHT, TRIAL, trial_loggers
from turbilux.site import SERIES_PAD_MINUTES


def _padded(trials: DataFrame, minutes: int) -> DataFrame:
    start, end = pad_window("start_time", "end_time", minutes)
    return trials.withColumns({"start_time": start, "end_time": end})


def paired_series(trials: DataFrame, samples: DataFrame, pad_minutes: int, day: str | None) -> DataFrame:
    """Sample pairs of the widened windows, with the trial's rolling width ``_k``; repeated samples give every pair."""
    columns = ["file_path", "number", "date_time", "temp_f", LIGHT] + ([day] if day else [])
    inside = samples_in_windows(
        samples.select(*columns),
        trial_loggers(_padded(trials, pad_minutes), "_k"),
        ["file_path"],
        day=day,
    )
    return pair_all(
        inside, [*TRIAL, "number", "date_time"], ["temp_f", LIGHT], extra=[F.max("_k").alias("_k")]
    )


def trial_series(
    trials: DataFrame,
    samples: DataFrame,
    *,
    pad_minutes: int = SERIES_PAD_MINUTES,
    window_width: int | None = None,
    zero_light: str = "ieee",
    day: str | None = None,
) -> DataFrame:
    """Long series: one row per trial, sample and logger.

    ``window_width`` overrides the trials' own ``sliding_window_width``.  Series of any length and windows of any width go
    the same way, cut into blocks.
    """
    width = F.lit(window_width) if window_width else F.round("sliding_window_width").cast("int")
    trials = trials.withColumn("_k", width)
    pairs = paired_series(trials, samples, pad_minutes, day)
    names = [f"{LIGHT}_rollmean_{n}" for n in (1, 2)]
    values = [f"{LIGHT}_{n}" for n in (1, 2)]
    rolled = blocked_rolling_mean(
        pairs,
        values,
        "_k",
        by=TRIAL,
        # pairs of repeated samples stand in the order of their values
        order=["number", "date_time", *values, "temp_f_1", "temp_f_2"],
        names=names,
        chunk=F.floor(F.col("number") / BLOCK_ROWS),
    )

    pct = attenuation_pct(*values, zero_light)
    roll_pct = attenuation_pct(*names, zero_light)
    wide = rolled.drop("_k").withColumns(
        {
            "light_attenuation_pct": pct,
            "light_attenuation_rollmean_pct": roll_pct,
            "attenuation_on_axis": scale_to_axis(pct),
            "attenuation_rollmean_on_axis": scale_to_axis(roll_pct),
            "title": trial_title("date", "point_name", "disturbance_number"),
        }
    )
    return unpivot_loggers(wide, ["temp_f", LIGHT, f"{LIGHT}_rollmean"])
