"""Joins of a large frame with metadata.

They are plain equi-joins: the optimizer and adaptive execution broadcast a side that turns out small, and split the
oversized partition of a hot key (a file or pole with a large share of all samples).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turbilux.functions.times import in_window, wall_seconds


def lookup_join(facts: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join every fact row with its lookup rows (``inner`` or ``left``)."""
    if how not in ("inner", "left"):
        raise ValueError("lookup_join keeps the fact side: use inner or left")
    return facts.join(lookup, list(on), how)


def window_days(windows: DataFrame, start: str, end: str, day: str) -> DataFrame:
    """One row per window and calendar day it touches."""
    days = F.sequence(F.to_date(start), F.to_date(end))
    return windows.filter(F.col(start) < F.col(end)).withColumn(day, F.explode(days))


def window_bin_seconds(windows: DataFrame, start: str = "start_time", end: str = "end_time", per_window: int = 8) -> int:
    """Width of bins that cuts the windows into about ``per_window`` bins each, taken from all windows (one row to the driver).

    Whatever the lengths, the bins of all windows are at most ``per_window`` + 2 times as many as the windows, and one more
    for each midnight that a window crosses.  A day if there is no window.
    """
    length = wall_seconds(end) - wall_seconds(start)
    row = windows.filter(F.col(start) < F.col(end)).agg(F.count(F.lit(1)).alias("n"), F.sum(length).alias("seconds")).first()
    return max(1, -(-(row["seconds"] or 0) // (row["n"] * per_window))) if row["n"] else 86_400


def window_bins(windows: DataFrame, start: str, end: str, day: str, bin_: str, seconds: int) -> DataFrame:
    """One row per window, calendar day and bin of ``seconds`` seconds that it touches."""
    midnight = wall_seconds(F.col(day).cast("timestamp_ntz"))
    first = F.greatest(wall_seconds(start), midnight)
    last = F.least(wall_seconds(end), midnight + 86_399)
    return window_days(windows, start, end, day).withColumn(
        bin_, F.explode(F.sequence(F.floor(first / seconds), F.floor(last / seconds)))
    )


def samples_in_windows(
    samples: DataFrame,
    windows: DataFrame,
    on: Sequence[str] = (),
    *,
    ts: str = "date_time",
    start: str = "start_time",
    end: str = "end_time",
    day: str | None = None,
    bin_seconds: int | None = None,
) -> DataFrame:
    """Range join: samples with ``start <= ts < end`` of a window that shares the ``on`` keys.

    The calendar day turns the range into an equi-join, so no plan falls back to a
    nested loop; a sample in several windows comes back once per window.  ``day`` names
    the samples' own day column (their partition column, which then prunes the scan).
    Without a file key all samples of a busy day share one key: ``bin_seconds`` (see
    ``window_bin_seconds``) adds a bin below the day, so that they become many.
    """
    if bin_seconds is not None and bin_seconds < 1:
        raise ValueError("bin_seconds must be at least 1")
    key = day or "_day"
    keyed = samples if day else samples.withColumn(key, F.to_date(ts))
    keys, added = [*on, key], [] if day else [key]
    if bin_seconds is None:
        pieces = window_days(windows, start, end, key)
    else:
        keyed = keyed.withColumn("_bin", F.floor(wall_seconds(ts) / bin_seconds))
        pieces = window_bins(windows, start, end, key, "_bin", bin_seconds)
        keys, added = [*keys, "_bin"], [*added, "_bin"]
    return lookup_join(keyed, pieces, keys).filter(in_window(ts, start, end)).drop(*added)


def left_join_on(left: DataFrame, right: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """Left join on differently named keys (left name -> right name); right keys are dropped.

    Both sides are of trial size; the optimizer picks the strategy from their sizes.
    """
    renamed = right
    for ours, theirs in pairs.items():
        if ours != theirs:
            renamed = renamed.withColumnRenamed(theirs, ours)
    return left.join(renamed, list(pairs), "left")


def join_disturbances(deployments: DataFrame, disturbances: DataFrame, on: Sequence[str] = ("date",)) -> DataFrame:
    """Every deployment with every disturbance of its day; days without one stay."""
    return deployments.join(disturbances, list(on), "left")


def join_problem_poles(trials: DataFrame, problems: DataFrame) -> DataFrame:
    """Adds ``problem`` (NULL when the pole is not listed for that trial)."""
    return left_join_on(
        trials,
        problems,
        {"date": "date", "point_name": "pole_id", "disturbance_number": "disturbance"},
    )


def join_coordinates(
    trials: DataFrame,
    coordinates: DataFrame,
    on: Sequence[str] = ("point_name", "date", "disturbance_number"),
) -> DataFrame:
    """Adds ``coord_x`` and ``coord_y``; several coordinate rows of a pole give several rows."""
    if "disturbance_number" in on and "disturbance_number" not in coordinates.columns:
        coordinates = coordinates.withColumnRenamed("disturbance_id", "disturbance_number")
    return trials.join(coordinates.select(*on, "coord_x", "coord_y"), list(on), "left")
