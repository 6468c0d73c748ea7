"""Attenuation of light between the upper and the lower logger of a pole."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from turbilux.functions.missing import as_column, nan_to_null
from turbilux.site import AXIS_SCALE, ROLLING_WINDOW_SECONDS

ZERO_LIGHT = ("ieee", "skip")


def _percent_change(part: Column, base: Column, zero_light: str) -> Column:
    if zero_light not in ZERO_LIGHT:
        raise ValueError(f"zero_light must be one of {ZERO_LIGHT}, not {zero_light!r}")
    ratio = F.try_divide(100 * part, base)
    if zero_light == "skip":
        return nan_to_null(ratio)
    # x/0 keeps the sign of x, 0/0 is missing
    infinite = F.when(part > 0, F.lit(float("inf"))).when(part < 0, F.lit(float("-inf")))
    return nan_to_null(F.when(base == 0, infinite).otherwise(ratio))


def attenuation_pct(top: Column | str, bottom: Column | str, zero_light: str = "ieee") -> Column:
    """Percent of the upper logger's light that does not reach the lower one."""
    top, bottom = as_column(top), as_column(bottom)
    return _percent_change(top - bottom, top, zero_light)


def legacy_attenuation(intensity_1: Column | str, intensity_2: Column | str, zero_light: str = "ieee") -> Column:
    """The older definition: change from logger 1 to logger 2, on window means."""
    one, two = as_column(intensity_1), as_column(intensity_2)
    return _percent_change(two - one, one, zero_light)


def rolling_width(measurement_interval: Column | str, seconds: int = ROLLING_WINDOW_SECONDS) -> Column:
    """Samples in a rolling window; not rounded (the series rounds it)."""
    return F.try_divide(F.lit(float(seconds)), as_column(measurement_interval)) + 1


def scale_to_axis(attenuation: Column | str, factor: float = AXIS_SCALE) -> Column:
    return as_column(attenuation) * F.lit(factor)


def unscale_from_axis(scaled: Column | str, factor: float = AXIS_SCALE) -> Column:
    return as_column(scaled) / F.lit(factor)
