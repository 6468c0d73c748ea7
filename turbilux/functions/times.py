"""Wall-clock times.  Loggers carry no zone, so everything is TIMESTAMP_NTZ."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from turbilux.functions.missing import as_column

def _wall_clock(year, month, day, hour, minute, second) -> Column:
    """NULL for anything that is no time; built from parts, so no zone ever applies."""
    return F.try_make_timestamp_ntz(year, month, day, hour, minute, second.cast("decimal(16,6)"))


def _parts(text: Column, separator: str):
    pieces = F.split(text, separator)

    def whole(i: int, absent: int | None = None) -> Column:
        piece = F.get(pieces, F.lit(i))
        number = piece.try_cast("int")
        return number if absent is None else F.when(piece.isNull(), F.lit(absent)).otherwise(number)

    return whole


def parse_logger_timestamp(c: Column | str) -> Column:
    """``09/25/22 07:01:00 AM``, ``11/9/22 4:59 PM``, ``11/9/2022 12:30`` or ``11/9/2022 12:30:20`` to a wall-clock timestamp."""
    text = F.trim(as_column(c))
    half = text.endswith("AM") | text.endswith("PM")
    digits = F.when(half, F.rtrim(F.left(text, F.length(text) - 2))).otherwise(text)
    # one kind of separator: splitting on a single character needs no pattern matching
    part = _parts(F.translate(digits, "/:", "  "), " ")
    hour = F.when(text.endswith("PM"), part(3) % 12 + 12).when(text.endswith("AM"), part(3) % 12).otherwise(part(3))
    year = F.when(part(2) < 100, part(2) + 2000).otherwise(part(2))
    return _wall_clock(year, part(0), part(1), hour, part(4), part(5, absent=0))


def parse_date(c: Column | str) -> Column:
    """``2022-10-01`` or ``10/1/2022``."""
    text = F.trim(as_column(c))
    part = _parts(text, "/")
    zero = F.lit(0)
    us = _wall_clock(part(2), part(0), part(1), zero, zero, zero).cast("date")
    return F.when(F.contains(text, F.lit("/")), us).otherwise(text.try_cast("date"))


def date_plus_time(date: Column | str, time: Column | str) -> Column:
    """The day of one timestamp/date column with the time of day (whole seconds) of another."""
    d, t = as_column(date), as_column(time)
    return F.make_timestamp_ntz(
        F.year(d), F.month(d), F.dayofmonth(d), F.hour(t), F.minute(t), F.second(t)
    )


def date_plus_time_text(date: Column | str, time: Column | str) -> Column:
    """As ``date_plus_time`` for times kept as ``H:mm`` or ``H:mm:ss`` text."""
    d = as_column(date)
    part = _parts(F.trim(as_column(time)), ":")
    return _wall_clock(F.year(d), F.month(d), F.dayofmonth(d), part(0), part(1), part(2, absent=0))


def date_of(ts: Column | str) -> Column:
    return F.to_date(as_column(ts))


def in_window(ts: Column | str, start: Column | str, end: Column | str) -> Column:
    """Half-open: ``start <= ts < end``."""
    ts = as_column(ts)
    return (ts >= as_column(start)) & (ts < as_column(end))


def pad_window(start: Column | str, end: Column | str, minutes: int) -> tuple[Column, Column]:
    pad = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes), F.lit(0))
    return as_column(start) - pad, as_column(end) + pad


def wall_seconds(ts: Column | str) -> Column:
    """Whole seconds since 1970-01-01 on the wall clock: monotone, free of zone rules."""
    ts = as_column(ts)
    day = F.unix_date(F.to_date(ts)).cast("bigint")
    return day * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Seconds as a double, fractions kept."""
    return (as_column(end) - as_column(start)).cast("decimal(20,6)").cast("double")
