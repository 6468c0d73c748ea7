"""The study's inputs stood in for by the given tables (see FIXTURES.md).

Each function is a DataFrame over whole tables; nothing is sampled or cached.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turbilux.functions.geometry import polar_x, polar_y
from turbilux.operators.joins import left_join_on, samples_in_windows
from turbilux.operators.pairing import mean_attenuation, pair_samples
from turbilux.sources.metadata import COORDINATE_TYPES, clean_metadata

TRIAL_BY_POLE = ("date", "disturbance_number", "pole_id")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hour_slot(ts: str = "ts"):
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def raw_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as logger samples: two loggers per pole, time cut to the hour."""
    return table(spark, sf_dir, "events").select(
        F.floor(F.col("user_id") / 2).cast("bigint").alias("pole_id"),
        ((F.col("user_id") % 2).cast("int") + 1).alias("logger_number"),
        hour_slot().alias("slot_ts"),
        F.col("value").alias("intensity"),
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean light per pole, logger and hour."""
    return (
        raw_samples(spark, sf_dir)
        .groupBy("pole_id", "logger_number", "slot_ts")
        .agg(F.avg("intensity").alias("intensity"))
    )


def reading_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``readings`` of both loggers side by side, straight from the events: one shuffle."""
    return pair_samples(raw_samples(spark, sf_dir), ["pole_id", "slot_ts"], ["intensity"], cell="mean")


def disturbances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three trials of six hours on every day that has events."""
    days = table(spark, sf_dir, "events").select(F.to_date("ts").alias("date")).distinct()
    trials = days.withColumn("disturbance_number", F.explode(F.sequence(F.lit(1), F.lit(3))))
    midnight = F.col("date").cast("timestamp_ntz")

    def at(hour):
        return midnight + F.make_dt_interval(F.lit(0), hour)

    first_hour = (F.col("disturbance_number") - 1) * 8
    return trials.select(
        "date", "disturbance_number", at(first_hour + 1).alias("start_time"), at(first_hour + 7).alias("end_time")
    )


def trial_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples_in_windows(
        reading_pairs(spark, sf_dir), disturbances(spark, sf_dir), ts="slot_ts"
    )


def attenuation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean attenuation per day, disturbance and pole."""
    return mean_attenuation(trial_pairs(spark, sf_dir), TRIAL_BY_POLE, "intensity", zero_light="skip")


def poles(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        *extra,
        key.alias("pole_id"),
        F.when(key % 3 != 0, ((key * 7) % 340 - 20).cast("double")).alias("coord_x"),
        F.when(key % 5 != 0, ((key * 10) % 230 - 20).cast("double")).alias("coord_y"),
        ((key * 15) % 360).cast("double").alias("angle_degrees"),
        (20 + (key * 5) % 150).cast("double").alias("distance_from_disturbance_ft"),
        (50 * (key % 6)).cast("double").alias("reference_coord_x"),
        (25 * (key % 6)).cast("double").alias("reference_coord_y"),
    )


def pole_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``poles`` with polar coordinates resolved."""
    angle = F.radians("angle_degrees")
    reach = "distance_from_disturbance_ft"
    return poles(spark, sf_dir).select(
        "pole_id",
        polar_x("coord_x", "reference_coord_x", reach, angle).alias("coord_x"),
        polar_y("coord_x", "coord_y", "reference_coord_y", reach, angle).alias("coord_y"),
    )


def problem_poles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "supplier")
        .filter(F.col("s_acctbal") < 1000)
        .select(F.col("s_suppkey").alias("pole_id"), F.lit("flagged").alias("problem"))
    )


def attenuation_with_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return left_join_on(attenuation(spark, sf_dir), problem_poles(spark, sf_dir), {"pole_id": "pole_id"})


# --- the full trial pipeline: files, deployments and sheets --------------------------


def file_path(user="user_id", ts="ts"):
    return F.concat(F.lit("logs/"), F.col(user).cast("string"), F.lit("/"), F.to_date(ts).cast("string"), F.lit(".csv"))


def file_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per user and day; an hour's events make one sample."""
    hours = (
        table(spark, sf_dir, "events")
        .groupBy("user_id", hour_slot().alias("date_time"))
        .agg(
            F.min("value").alias("temp_f"),
            F.avg("value").alias("intensity_lum_ft2"),
            F.bool_and(F.col("event_type") == "error").alias("is_event"),
        )
    )
    return hours.select(
        F.concat(F.lit("../"), file_path(ts="date_time")).alias("file_path"),
        (F.hour("date_time") + 1).alias("number"),
        "date_time",
        "temp_f",
        "intensity_lum_ft2",
        "is_event",
    )


def deployment_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One logger file per pole, logger and day; very bright files have an issue."""
    files = table(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").alias("date")).agg(
        F.max("value").alias("brightest"), F.concat(F.count("value").cast("string"), F.lit(" events")).alias("notes")
    )
    sheet = files.select(
        "date",
        F.floor(F.col("user_id") / 2).cast("bigint").cast("string").alias("point_name"),
        ((F.col("user_id") % 2).cast("int") + 1).alias("logger_number_per_pole"),
        file_path(ts="date").alias("lightlogger_file_path"),
        F.concat(F.col("user_id").cast("string"), F.lit(".csv")).alias("lightlogger_file_name"),
        "notes",
        F.when(F.col("brightest") > 150, F.lit("too bright")).alias("data_issue"),
    )
    return sheet


def problem_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "supplier")
        .filter(F.col("s_acctbal") < 1000)
        .select(
            F.date_add(F.lit("2024-01-01").cast("date"), F.col("s_nationkey")).alias("date"),
            F.col("s_suppkey").cast("string").alias("pole_id"),
            (F.col("s_nationkey") % 3 + 1).cast("int").alias("disturbance"),
            F.lit("flagged").alias("problem"),
        )
    )


def coordinate_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a hand-kept sheet: text cells, several spellings of "missing"."""
    placed = poles(spark, sf_dir, "c_mktsegment", "c_nationkey")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" na "))
    sheet = placed.select(
        F.date_format(F.date_add(F.lit("2022-06-20").cast("date"), F.col("c_nationkey")), "M/d/yyyy").alias("Date"),
        (F.col("c_nationkey") % 3 + 1).cast("string").alias("Disturbance ID"),
        F.col("c_nationkey").cast("string").alias("Line ID"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "x")
        .otherwise(F.lower(F.substring("c_mktsegment", 1, 1)))
        .alias("Point Name"),
        F.col("pole_id").alias("Point ID"),
        text("coord_x").alias("Coord X"),
        text("coord_y").alias("Coord Y"),
        text("angle_degrees").alias("Angle (degrees)"),
        text("distance_from_disturbance_ft").alias("Distance from disturbance, ft"),
        text("reference_coord_x").alias("Reference Coord X"),
        text("reference_coord_y").alias("Reference Coord Y"),
        F.lit("?").alias("_c11"),
    )
    return clean_metadata(sheet, COORDINATE_TYPES)


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written out as logger files, one per user, in the three layouts in use."""
    events = table(spark, sf_dir, "events").withColumn("layout", (F.col("user_id") % 3).cast("int"))
    path = F.concat(F.lit("logs/"), F.col("user_id").cast("string"), F.lit("_export.csv")).alias("file_path")
    sn = F.col("user_id").cast("string")
    sensor = F.concat(F.lit(" (LGR S/N: "), sn, F.lit(", SEN S/N: "), sn, F.lit(")"))
    flag = F.concat(F.lit(" (LGR S/N: "), sn, F.lit(")"))

    def header(quoted: bool, offset: str, events_: list[str]):
        q = '"' if quoted else ""
        parts = [F.lit(f'{q}#{q},"Date Time, GMT{offset}","Temp, °F'), sensor, F.lit('","Intensity, lum/ft²'), sensor, F.lit('"')]
        for e in events_:
            parts += [F.lit(f",{q}{e}"), flag, F.lit(q)]
        return F.concat(*parts)

    quoted = F.col("layout") == 0
    files = events.select("user_id", "layout").distinct()
    heads = F.when(
        quoted,
        F.concat(header(True, "-05:00", ["Button Down", "Button Up", "Host Connected", "End Of File"]), F.lit("\r")),
    ).otherwise(header(False, "-06:00", ["Stopped", "End Of File"]))
    titles = F.when(quoted, F.concat(F.lit('\ufeff"Plot Title: '), sn, F.lit('"\r'))).otherwise(
        F.concat(F.lit("Plot Title: "), sn, F.lit(",,,,,"))
    )
    time = (
        F.when(quoted, F.date_format("ts", "MM/dd/yy hh:mm:ss a"))
        .when(F.col("layout") == 1, F.date_format("ts", "M/d/yyyy H:mm"))
        .otherwise(F.date_format("ts", "MM/dd/yy h:mm:ss a"))
    )
    mark = F.when(F.col("event_type") == "error", "Logged").otherwise("")
    line = F.concat(
        F.col("event_id").cast("string"), F.lit(","), time, F.lit(","),
        F.round(F.col("value") + 60, 2).cast("string"), F.lit(","), F.col("value").cast("string"), F.lit(","), mark,
        F.when(quoted, F.lit(",,,\r")).otherwise(F.lit(",")),
    )
    return (
        files.select(path, titles.alias("value"))
        .unionByName(files.select(path, heads.alias("value")))
        .unionByName(events.select(path, line.alias("value")))
    )


def broken_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``log_lines`` with lines no logger file should have: remarks, blank lines and times that are none."""
    number = F.col("event_id").cast("string")
    broken = (
        F.when(F.col("event_id") % 10 == 0, F.concat(F.lit("battery low at "), number))
        .when(F.col("event_id") % 10 == 1, F.lit("   "))
        .when(F.col("event_id") % 10 == 2, F.concat(number, F.lit(",13/40/22 10:00:00 AM,70.1,1.0,,")))
    )
    path = F.concat(F.lit("logs/"), F.col("user_id").cast("string"), F.lit("_export.csv")).alias("file_path")
    more = table(spark, sf_dir, "events").filter(F.col("event_id") % 10 < 3).select(path, broken.alias("value"))
    return log_lines(spark, sf_dir).unionByName(more)


def partial_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as single samples of one file per user, where some files lack a sensor and some rows a value."""
    events = table(spark, sf_dir, "events")
    user, event = F.col("user_id"), F.col("event_id")
    return events.select(
        F.concat(F.lit("logs/"), user.cast("string")).alias("file_path"),
        event.cast("int").alias("number"),
        F.col("ts").alias("date_time"),
        F.when((user % 3 != 0) & (event % 7 != 0), F.col("value")).alias("temp_f"),
        F.when((user % 4 != 0) & (event % 5 != 0), F.col("value") + 1).alias("intensity_lum_ft2"),
        (F.col("event_type") == "error").alias("is_event"),
    )
