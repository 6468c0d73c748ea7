import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from turbilux.functions import geometry as G
from turbilux.functions import light as L
from turbilux.functions import missing as M
from turbilux.functions import times as T
from turbilux.site import TRACK_BREAKS, TRACK_LEVELS

INF, NAN = float("inf"), float("nan")


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_attenuation_with_zero_light(spark):
    rows = [(10.0, 4.0), (0.0, 5.0), (0.0, -5.0), (0.0, 0.0), (None, 1.0), (NAN, 1.0), (8.0, 8.0)]
    df = spark.createDataFrame(rows, "a double, b double").coalesce(1)
    assert values(df, L.attenuation_pct("a", "b")) == [60.0, -INF, INF, None, None, None, 0.0]
    assert values(df, L.attenuation_pct("a", "b", "skip")) == [60.0, None, None, None, None, None, 0.0]
    assert values(df, L.legacy_attenuation("a", "b")) == [-60.0, INF, -INF, None, None, None, 0.0]
    with pytest.raises(ValueError):
        L.attenuation_pct("a", "b", "drop")


def test_rolling_width_and_axis(spark):
    df = spark.createDataFrame([(20.0,), (0.0,), (None,)], "s double").coalesce(1)
    assert values(df, L.rolling_width("s")) == [16.0, None, None]
    assert values(df, L.unscale_from_axis(L.scale_to_axis("s"))) == [20.0, 0.0, None]


def test_logger_time_layouts(spark):
    rows = [
        ("09/25/22 07:01:00 AM", dt.datetime(2022, 9, 25, 7, 1)),
        ("11/09/22 12:30:00 PM", dt.datetime(2022, 11, 9, 12, 30)),
        ("11/09/22 4:59:59 PM", dt.datetime(2022, 11, 9, 16, 59, 59)),
        ("11/9/2022 12:30", dt.datetime(2022, 11, 9, 12, 30)),
        ("11/9/2022 16:59:07", dt.datetime(2022, 11, 9, 16, 59, 7)),
        ("11/10/22 12:00:00 AM", dt.datetime(2022, 11, 10)),
        ("soon", None),
        (None, None),
    ]
    df = spark.createDataFrame(rows, "s string, t timestamp_ntz").coalesce(1)
    assert values(df, T.parse_logger_timestamp("s")) == [r[1] for r in rows]


def test_dates_and_day_times(spark):
    df = spark.createDataFrame(
        [("2022-10-01", "10:28"), ("10/1/2022", "9:05:30"), ("x", "y")], "d string, t string"
    ).coalesce(1)
    day = T.parse_date("d")
    assert values(df, day) == [dt.date(2022, 10, 1), dt.date(2022, 10, 1), None]
    assert values(df, T.date_plus_time_text(day, "t")) == [
        dt.datetime(2022, 10, 1, 10, 28),
        dt.datetime(2022, 10, 1, 9, 5, 30),
        None,
    ]
    clock = F.lit("1899-12-31 11:51:02.7").cast("timestamp_ntz")
    assert values(df, T.date_plus_time(day, clock))[0] == dt.datetime(2022, 10, 1, 11, 51, 2)


def test_window_is_half_open_and_padded(spark):
    df = spark.sql(
        "select timestamp_ntz'2022-01-01 10:00:00' s, timestamp_ntz'2022-01-01 10:30:00' e, "
        "explode(array(timestamp_ntz'2022-01-01 09:59:59', timestamp_ntz'2022-01-01 10:00:00', "
        "timestamp_ntz'2022-01-01 10:29:59', timestamp_ntz'2022-01-01 10:30:00')) t"
    )
    assert values(df, T.in_window("t", "s", "e")) == [False, True, True, False]
    start, end = T.pad_window("s", "e", 20)
    assert df.select(start, end).first() == (dt.datetime(2022, 1, 1, 9, 40), dt.datetime(2022, 1, 1, 10, 50))


def test_times_ignore_zone_rules(spark):
    """Clock changes of the session's zone must not move wall-clock times."""
    spark.conf.set("spark.sql.session.timeZone", "America/Chicago")
    try:
        df = spark.sql("select timestamp_ntz'2022-03-13 02:30:00' a, timestamp_ntz'2022-03-13 03:00:00' b")
        assert values(df, T.seconds_between("a", "b")) == [1800.0]
        assert values(df, T.wall_seconds("b") - T.wall_seconds("a")) == [1800]
        text = spark.sql("select '3/13/2022 2:30' s")
        assert values(text.select(T.date_plus_time_text(F.lit("2022-03-13").cast("date"), F.lit("2:30")).alias("t")), "t") == [
            dt.datetime(2022, 3, 13, 2, 30)
        ]
        assert values(text, T.parse_logger_timestamp("s")) == [dt.datetime(2022, 3, 13, 2, 30)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_tracks_and_zones(spark):
    df = spark.createDataFrame(
        [(-0.1,), (0.0,), (49.9,), (50.0,), (99.9,), (100.0,), (199.9,), (200.0,), (200.1,), (300.0,), (300.1,), (None,), (NAN,)],
        "v double",
    ).coalesce(1)
    assert values(df, G.track_of("v")) == ["U", "3", "3", "3", "3", "2", "2", "1", "1", "1", None, None, None]
    assert values(df, G.zone_of("v")) == ["U", "A", "A", "B", "B", "C", "C", "C", None, None, None, None, None]


def test_ordinals_and_tiles(spark):
    df = spark.createDataFrame([("1", "U"), ("U", "C"), (None, "x")], "track string, zone string").coalesce(1)
    assert [tuple(r) for r in df.select(*G.tile_bounds()).collect()] == [
        (0.5, 1.5, 0.5, 1.5),
        (3.5, 4.5, 3.5, 4.5),
        (None, None, None, None),
    ]
    assert values(df, G.ordinal("track", TRACK_LEVELS)) == [1, 4, None]


def test_polar_coordinates(spark):
    rows = [
        (5.0, 6.0, 5.0, 6.0),
        (5.0, None, 5.0, 35.0),
        (None, 6.0, 100.0, 35.0),  # y is recomputed although it was given
        (NAN, None, 100.0, 35.0),
    ]
    df = spark.createDataFrame([(x, y) for x, y, *_ in rows], "x double, y double").coalesce(1)
    angle = G.deg_to_rad(F.lit(90.0))
    ys = values(df, G.polar_y("x", "y", F.lit(25.0), F.lit(10.0), angle))
    xs = values(df, G.polar_x("x", F.lit(100.0), F.lit(10.0), angle))
    assert all(math.isclose(a, r[2]) and math.isclose(b, r[3]) for a, b, r in zip(xs, ys, rows))


def test_segments_are_exact_lookups(spark):
    df = spark.createDataFrame([(50.0, 25.0), (0.0, 150.0), (50.1, 24.9), (None, 75.0)], "x0 double, y0 double").coalesce(1)
    assert [tuple(r) for r in df.select(*G.segment_of("x0", "y0")).collect()] == [
        (2.5, 3.5, 1.5, 2.5),
        (3.5, 3.5, 3.5, 4.5),
        (None, None, None, None),
        (None, None, 2.5, 3.5),
    ]


def test_border_flag_is_strict_and_never_null(spark):
    df = spark.createDataFrame([(3.5,), (3.4,), (-3.5,), (96.5,), (96.6,), (303.4,), (None,), (NAN,)], "v double").coalesce(1)
    assert values(df, G.border_flag("v", TRACK_BREAKS)) == [False, True, False, False, True, True, False, False]


def test_rounding_is_half_to_even(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,), (None,)], "v double").coalesce(1)
    assert values(df, G.round_label("v")) == [0.0, 2.0, 2.0, 0.0, None]
    assert values(df, G.snap_to(F.col("v") * 100)) == [0.0, 200.0, 200.0, 0.0, None]
    assert values(df, G.mirror_x(F.col("v") * 0))[0] == 0.0
    assert math.copysign(1, values(df, G.mirror_x(F.col("v") * 0))[0]) == 1.0


def test_missing(spark):
    df = spark.createDataFrame([(" na",), ("NA",), ("",), ("?",), (" a ",), ("Na",), (None,)], "s string").coalesce(1)
    assert values(df, M.na_tokens_to_null("s")) == [None, None, None, None, "a", "Na", None]
    num = spark.createDataFrame([(1.0,), (NAN,), (INF,), (None,)], "v double").coalesce(1)
    assert values(num, M.nan_to_null("v")) == [1.0, None, INF, None]
    assert values(num, M.present_number("v")) == [True, False, True, False]


def test_title(spark):
    df = spark.sql("select date'2022-10-01' d, 'B' p, 2 n")
    assert values(df, G.trial_title("d", "p", "n")) == ["2022-10-01, Pole B, Disturbance 2"]


def test_minute_times_of_twelve_hours(spark):
    df = spark.createDataFrame([("11/9/22 4:59 PM",), ("11/9/22 12:05 AM",), ("11/9/22 12:05:30 PM",)], "t string")
    got = [r[0] for r in df.select(T.parse_logger_timestamp("t")).collect()]
    assert got == [dt.datetime(2022, 11, 9, 16, 59), dt.datetime(2022, 11, 9, 0, 5), dt.datetime(2022, 11, 9, 12, 5, 30)]
