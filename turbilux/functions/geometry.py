"""Site coordinates, tracks, zones and borders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from turbilux.functions.missing import as_column
from turbilux.site import (
    BORDER_FUDGE,
    SEGMENT_X,
    SEGMENT_Y,
    TRACK_BREAKS,
    TRACK_LABELS,
    TRACK_LEVELS,
    UNCLASSIFIED,
    ZONE_BREAKS,
    ZONE_LABELS,
    ZONE_LEVELS,
)


def _missing(c: Column) -> Column:
    return c.isNull() | F.isnan(c)


def deg_to_rad(degrees: Column | str) -> Column:
    return F.radians(as_column(degrees))


def polar_y(x: Column | str, y: Column | str, ref_y: Column | str, distance: Column | str, angle: Column | str) -> Column:
    """Surveyed y, or the polar one where x **or** y was not surveyed."""
    x, y = as_column(x), as_column(y)
    polar = as_column(ref_y) + as_column(distance) * F.sin(as_column(angle))
    return F.when(_missing(y) | _missing(x), polar).otherwise(y)


def polar_x(x: Column | str, ref_x: Column | str, distance: Column | str, angle: Column | str) -> Column:
    """Surveyed x, or the polar one (x grows against the angle's direction)."""
    x = as_column(x)
    polar = as_column(ref_x) - as_column(distance) * F.cos(as_column(angle))
    return F.when(_missing(x), polar).otherwise(x)


def mirror_x(x: Column | str) -> Column:
    # + 0.0 keeps a mirrored zero positive
    return -as_column(x) + F.lit(0.0)


def _interval_label(v: Column, breaks: Sequence[float], labels: Sequence[str]) -> Column:
    """[b0,b1) [b1,b2) ... [bn-1,bn]; below b0 unclassified, above bn NULL."""
    label = F.when(v < breaks[0], F.lit(UNCLASSIFIED))
    for upper, name in zip(breaks[1:-1], labels):
        label = label.when(v < upper, F.lit(name))
    # NaN sorts above every number, so it fails this test too
    return label.when(v <= breaks[-1], F.lit(labels[-1]))


def track_of(x: Column | str) -> Column:
    return _interval_label(as_column(x), TRACK_BREAKS, TRACK_LABELS)


def zone_of(y: Column | str) -> Column:
    return _interval_label(as_column(y), ZONE_BREAKS, ZONE_LABELS)


def ordinal(c: Column | str, levels: Sequence[str]) -> Column:
    """1-based position of an ordered level; NULL for anything else."""
    found = F.array_position(F.array(*(F.lit(level) for level in levels)), as_column(c))
    return F.when(found > 0, found).cast("int")


def track_ordinal(track: Column | str = "track") -> Column:
    return ordinal(track, TRACK_LEVELS)


def zone_ordinal(zone: Column | str = "zone") -> Column:
    return ordinal(zone, ZONE_LEVELS)


def tile_bounds(track: Column | str = "track", zone: Column | str = "zone") -> list[Column]:
    """xmin, xmax, ymin, ymax of the cell's unit square on the drawing."""
    x, y = track_ordinal(track), zone_ordinal(zone)
    return [
        (x - F.lit(0.5)).alias("xmin"),
        (x + F.lit(0.5)).alias("xmax"),
        (y - F.lit(0.5)).alias("ymin"),
        (y + F.lit(0.5)).alias("ymax"),
    ]


def _segment(v: Column, table: Mapping[float, tuple[float, float]], end: int) -> Column:
    pairs = (F.when(v == F.lit(at), F.lit(ends[end])) for at, ends in table.items())
    return F.coalesce(*pairs)


def segment_of(x: Column | str, y: Column | str) -> list[Column]:
    """x, xend, y, yend of a disturbance; exact lookup, NULL where not listed."""
    cx, cy = as_column(x), as_column(y)
    return [
        _segment(cx, SEGMENT_X, 0).alias("x"),
        _segment(cx, SEGMENT_X, 1).alias("xend"),
        _segment(cy, SEGMENT_Y, 0).alias("y"),
        _segment(cy, SEGMENT_Y, 1).alias("yend"),
    ]


def border_flag(v: Column | str, borders: Sequence[float], fudge: float = BORDER_FUDGE) -> Column:
    """True strictly within ``fudge`` of any border; never NULL."""
    v = as_column(v)
    near = F.lit(False)
    for b in borders:
        near = near | ((v > b - fudge) & (v < b + fudge))
    return F.coalesce(near, F.lit(False))


def snap_to(v: Column | str, step: float = 100.0) -> Column:
    """Nearest multiple, ties to the even one."""
    return F.bround(as_column(v) / F.lit(step), 0) * F.lit(step) + F.lit(0.0)


def round_label(v: Column | str) -> Column:
    """Whole number for a tile, ties to even."""
    return F.bround(as_column(v).cast("double"), 0) + F.lit(0.0)


def trial_title(date: Column | str, point: Column | str, disturbance: Column | str) -> Column:
    return F.concat(
        as_column(date).cast("string"),
        F.lit(", Pole "),
        as_column(point).cast("string"),
        F.lit(", Disturbance "),
        as_column(disturbance).cast("string"),
    )
