"""One row per pole, day and disturbance: files, time span and mean attenuation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turbilux.functions.light import rolling_width
from turbilux.operators.extent import common_extent, recorded_extent
from turbilux.operators.joins import join_disturbances, join_problem_poles, samples_in_windows
from turbilux.operators.pairing import SAMPLE_KEYS, mean_attenuation_of_samples
from turbilux.operators.reshape import pivot_loggers
from turbilux.operators.rows import (
    drop_event_rows,
    exclude_dates,
    exclude_flagged,
    exclude_matching,
    prefix_path,
    require_present,
)
from turbilux.site import EXCLUDED_TRIAL_DATES

TRIAL = ("date", "point_name", "disturbance_number")
PATH = "lightlogger_file_path"
LIGHT = "intensity_lum_ft2"
WIDE_VALUES = (PATH, "lightlogger_file_name", "notes")


def usable_deployments(deployments: DataFrame, path_prefix: str = "../") -> DataFrame:
    """Deployments that have a file, no known issue and no deprecated path."""
    kept = exclude_flagged(require_present(deployments, PATH))
    return exclude_matching(prefix_path(kept, PATH, path_prefix), PATH, "deprecated")


def sample_extents(samples: DataFrame, deployments: DataFrame | None = None) -> DataFrame:
    """Time span and sampling interval per ``file_path``, from clean samples without the last.

    Given deployments, files that none of them names stay out.  A sensor that recorded nothing in a file is left out of
    that file; of the others every row must have a value.
    """
    extents = recorded_extent(drop_event_rows(samples), ("temp_f", LIGHT))
    if deployments is None:
        return extents
    used = deployments.select(F.col(PATH).alias("file_path"))
    return extents.join(used, ["file_path"], "left_semi")


def pole_deployments(deployments: DataFrame, extents: DataFrame) -> DataFrame:
    """One row per pole and day: common time span, and file, name and notes per logger.

    Harmonising and pivoting share one aggregation, done before trials multiply the rows.
    """
    dated = deployments.join(extents.withColumnRenamed("file_path", PATH), [PATH], "left")
    return pivot_loggers(dated, ["date", "point_name"], WIDE_VALUES, extra=common_extent()).drop("n_1", "n_2", "n_3")


def planned_trials(
    deployments: DataFrame,
    extents: DataFrame,
    disturbances: DataFrame,
) -> DataFrame:
    """Poles with the disturbances of their day, before any light is looked at."""
    return join_disturbances(pole_deployments(deployments, extents), disturbances).withColumn(
        "sliding_window_width", rolling_width("measurement_interval")
    )


def trial_loggers(trials: DataFrame, *extra: str) -> DataFrame:
    """One row per trial and logger (1 upper, 2 lower), for trials that have both files."""
    files = F.array(*(F.struct(F.lit(n).alias("logger_number"), F.col(f"{PATH}_{n}").alias("file_path")) for n in (1, 2)))
    both = trials.filter(F.col(f"{PATH}_1").isNotNull() & F.col(f"{PATH}_2").isNotNull())
    return both.select(*TRIAL, "start_time", "end_time", *extra, F.explode(files).alias("_logger")).select(
        *TRIAL, "start_time", "end_time", *extra, "_logger.*"
    )


def deployed_loggers(deployments: DataFrame, disturbances: DataFrame) -> DataFrame:
    """``trial_loggers`` straight from the sheets: no file, no pivot needed."""
    loggers = deployments.filter(F.col("logger_number_per_pole").isin(1, 2)).select(
        "date", "point_name", F.col("logger_number_per_pole").alias("logger_number"), F.col(PATH).alias("file_path")
    )
    return loggers.join(disturbances.select("date", "disturbance_number", "start_time", "end_time"), "date")


def trial_means(
    loggers: DataFrame,
    samples: DataFrame,
    pair_keys: Sequence[str] = SAMPLE_KEYS,
    zero_light: str = "ieee",
    day: str | None = None,
) -> DataFrame:
    """Mean attenuation of each trial that has sample pairs: one scan of the samples."""
    columns = ["file_path", "number", "date_time", LIGHT] + ([day] if day else [])
    inside = samples_in_windows(samples.select(*columns), loggers, ["file_path"], day=day)
    # samples may repeat: every combination counts, as in a natural join
    return mean_attenuation_of_samples(inside, TRIAL, pair_keys, LIGHT, zero_light)


def pole_trials(
    deployments: DataFrame,
    samples: DataFrame,
    disturbances: DataFrame,
    problems: DataFrame,
    *,
    extents: DataFrame | None = None,
    excluded_dates: Sequence[str] = EXCLUDED_TRIAL_DATES,
    pair_keys: Sequence[str] = SAMPLE_KEYS,
    zero_light: str = "ieee",
    day: str | None = None,
) -> DataFrame:
    """The trial table.  Trials without a pair of loggers or samples keep a NULL mean.

    ``deployments`` are usable ones.  Excluded days go before any sample is read.  Pass
    stored ``extents`` (``sample_extents`` of the stored samples) to save their scans.
    """
    deployments = exclude_dates(deployments, excluded_dates)
    if extents is None:
        extents = sample_extents(samples)
    trials = planned_trials(deployments, extents, disturbances)
    means = trial_means(deployed_loggers(deployments, disturbances), samples, pair_keys, zero_light, day)
    return join_problem_poles(trials.join(means, list(TRIAL), "left"), problems)
