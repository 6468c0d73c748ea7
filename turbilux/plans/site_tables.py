"""Coordinates, cells, roll-ups and the tables behind maps and heatmaps."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turbilux.functions.geometry import (
    deg_to_rad,
    mirror_x,
    polar_x,
    polar_y,
    round_label,
    segment_of,
)
from turbilux.operators import cells as C
from turbilux.operators.joins import join_coordinates
from turbilux.operators.reshape import arrange, split_on_borders
from turbilux.operators.rows import (
    clip_to_site,
    equals,
    exclude_dates,
    exclude_problem_poles,
    exclude_unclassified,
    require_present,
)
from turbilux.site import BORDER_FUDGE, DISTURBANCE_POINT, EXCLUDED_SEGMENT_DATES
from turbilux.sources.names import drop_spill_columns


def coordinates(sheet: DataFrame) -> DataFrame:
    """Site coordinates of every point, polar ones computed; names in upper case."""
    points = drop_spill_columns(sheet).withColumns(
        {"point_name": F.upper("point_name"), "angle_radians": deg_to_rad("angle_degrees")}
    )
    polar = ("distance_from_disturbance_ft", "angle_radians")
    # both read the surveyed x, so they are replaced in one step
    return points.withColumns(
        {
            "coord_y": polar_y("coord_x", "coord_y", "reference_coord_y", *polar),
            "coord_x": polar_x("coord_x", "reference_coord_x", *polar),
        }
    )


def disturbance_segments(
    coords: DataFrame,
    point: str = DISTURBANCE_POINT,
    excluded_dates: Sequence[str] = EXCLUDED_SEGMENT_DATES,
) -> DataFrame:
    """Where people walked: cell and drawn segment."""
    points = exclude_dates(equals(coords, point_name=point), excluded_dates).select(
        "coord_x", "coord_y", "point_name", "date", F.col("disturbance_id").alias("disturbance_number")
    )
    return C.classify(points).select("*", *segment_of("coord_x", "coord_y"))


def gridded_poles(
    trials: DataFrame,
    coords: DataFrame,
    exclude_problems: bool = False,
    on: Sequence[str] = ("point_name", "date", "disturbance_number"),
    fudge: float = BORDER_FUDGE,
    shift: float | None = None,
    normalise_names: bool = False,
) -> DataFrame:
    """Trial rows at their place on the grid; border poles count for every side.

    Coordinates have upper-case point names; trials are matched as written unless
    ``normalise_names``.
    """
    if exclude_problems:
        trials = exclude_problem_poles(trials)
    if normalise_names:
        trials = trials.withColumn("point_name", F.upper("point_name"))
    placed = join_coordinates(require_present(trials, "light_attenuation_mean"), coords, on)
    placed = require_present(placed, "coord_x", "coord_y").distinct()
    return C.classify(clip_to_site(split_on_borders(placed, fudge, shift)))


def cell_attenuation(
    trials: DataFrame,
    coords: DataFrame,
    exclude_problems: bool = False,
    min_mean: float | None = 0.0,
    order_free: bool = False,
    **grid_options,
) -> DataFrame:
    """Attenuation per day, disturbance, track and zone; with ``order_free`` equal bits on any cluster."""
    poles = gridded_poles(trials, coords, exclude_problems, **grid_options)
    return C.cell_stats(poles, min_mean=min_mean, order_free=order_free)


def heatmap(table: DataFrame, fill: str, label: str) -> DataFrame:
    """A roll-up with its fill value, tile label and tile bounds."""
    return C.with_tile_bounds(table.withColumns({"fill": F.col(fill), "label": round_label(label)}))


# name -> (roll-up of the cells, fill column, label column)
HEATMAPS: dict[str, tuple[Callable[[DataFrame], DataFrame], str, str]] = {
    "cell_mean": (lambda cells: cells, "mean_light_attenuation", "mean_light_attenuation"),
    "cell_sum": (lambda cells: cells, "sum_light_attenuation", "n"),
    "day_mean": (C.day_mean, "mean_light_attenuation", "mean_light_attenuation"),
    "day_sum": (C.day_sum, "sum_light_attenuation", "n"),
    "experiment_mean": (C.experiment_mean, "mean_light_attenuation", "mean_light_attenuation"),
}


def heatmaps(cells: DataFrame) -> dict[str, DataFrame]:
    """All heatmap tables of one cell table (cache or store ``cells`` before using several)."""
    return {name: heatmap(roll(cells), fill, label) for name, (roll, fill, label) in HEATMAPS.items()}


def all_heatmaps(
    trials: DataFrame, coords: DataFrame, min_mean: float | None = 0.0, problem: str = "problem", **grid_options
) -> DataFrame:
    """The tiles of every heatmap, with and without flagged poles, in one frame and from one pass over the poles.

    drawing (a name of ``HEATMAPS``), filtered, date, disturbance_number, track, zone, fill, label and the tile's bounds;
    keys that a drawing does not have are NULL.  A pole without a problem counts for both versions of its cell; cells, days
    and the experiment are then rolled up from the same aggregated cells.  The experiment is drawn unfiltered only.
    """
    poles = gridded_poles(trials, coords, **grid_options)
    versions = F.when(F.col(problem).isNull(), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    cells = C.cell_stats(poles.withColumn("filtered", F.explode(versions)), ("filtered", *C.CELL), min_mean=min_mean)
    values = ("mean_light_attenuation", "n", "sum_light_attenuation")

    def rolled(df: DataFrame, *by) -> DataFrame:
        mean, n, total = values
        return df.groupBy(*by).agg(C.mean_of(mean).alias(mean), F.sum(n).alias(n), C.sum_of(total).alias(total))

    def drawn(names: Sequence[str]):
        return F.array(
            *(
                F.struct(F.lit(name).alias("drawing"), F.col(fill).alias("fill"), round_label(label).alias("label"))
                for name, (_, fill, label) in HEATMAPS.items()
                if name in names
            )
        )

    days = rolled(cells, "filtered", *C.DAY)
    levels = days.withColumn("level", F.explode(F.array(F.lit("day"), F.lit("experiment"))))
    date = F.when(F.col("level") == "day", F.col("date")).alias("date")
    both = rolled(levels, "filtered", "level", date, *C.PLACE).filter("level = 'day' or not filtered")
    of_level = F.when(F.col("level") == "day", drawn(("day_mean", "day_sum"))).otherwise(drawn(("experiment_mean",)))
    keys = ("filtered", *C.CELL)
    tiles = cells.select(*keys, F.explode(drawn(("cell_mean", "cell_sum"))).alias("tile")).unionByName(
        both.withColumn("disturbance_number", F.lit(None).cast(dict(cells.dtypes)["disturbance_number"])).select(
            *keys, F.explode(of_level).alias("tile")
        )
    )
    return C.with_tile_bounds(tiles.select("tile.drawing", *keys, "tile.fill", "tile.label"))


def grid_tiles(spark) -> DataFrame:
    """The nine cells of the site with their bounds."""
    return C.with_tile_bounds(exclude_unclassified(C.grid(spark)))


def grid_with(table: DataFrame) -> DataFrame:
    """Grid outlines with the roll-up's values where it has the cell (``U`` cells drop out)."""
    return grid_tiles(table.sparkSession).join(table, ["track", "zone"], "left")


def pole_map(coords: DataFrame, date=None, order: Sequence[str] = ("date", "disturbance_id", "line_id")) -> DataFrame:
    """Poles as seen from the shore (x mirrored), in line order; all days, one day or a list of days."""
    days = [date] if date is None or isinstance(date, str | datetime.date) else list(date)
    points = coords if days == [None] else coords.filter(F.col("date").isin([F.lit(d).cast("date") for d in days]))
    return arrange(points.withColumn("map_x", mirror_x("coord_x")), *order)
