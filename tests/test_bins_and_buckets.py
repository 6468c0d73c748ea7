"""Range joins by bins below a day, and stored tables that join without a shuffle."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from plan_text import plan_of
from turbilux.operators import joins as J
from turbilux.plans.legacy import paired_window_means
from turbilux.sources import tables as TB

T0 = dt.datetime(2022, 9, 25, 0, 0)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


@pytest.fixture(scope="module")
def busy(spark):
    """One day holds nearly all samples; no file key."""
    rng = random.Random(2)
    data = [(n, at(rng.randrange(86400))) for n in range(3000)]
    data += [(n, at(86400 * rng.randrange(2, 5) + rng.randrange(86400))) for n in range(3000, 3100)]
    data += [(4000, None), (4001, at(3600)), (4002, at(7200)), (4003, at(86400)), (4004, at(7199) + dt.timedelta(microseconds=999_999))]
    return spark.createDataFrame(data, "number int, date_time timestamp_ntz")


@pytest.fixture(scope="module")
def windows(spark):
    data = [
        (1, at(3600), at(7200)),
        (2, at(3000), at(9000)),  # overlaps the first
        (3, at(80000), at(90000)),  # over midnight
        (4, at(0), at(86400)),  # ends at midnight
        (5, at(86400 * 2), at(86400 * 4 + 5)),
        (6, at(50), at(50)),  # empty
        (7, at(90), at(60)),  # backwards
        (8, None, at(60)),
        (9, at(7199), at(7200)),
    ]
    return spark.createDataFrame(data, "trial int, start_time timestamp_ntz, end_time timestamp_ntz")


def brute_force(samples, windows):
    kept = [w for w in windows.collect() if w.start_time]
    return sorted(
        (s.number, w.trial)
        for s in samples.collect()
        for w in kept
        if s.date_time and w.start_time <= s.date_time < w.end_time
    )


@pytest.mark.parametrize("seconds", [1, 7, 450, 3600, 50_000, 86_400, 200_000])
def test_bins_of_any_width_give_the_same_rows(busy, windows, seconds):
    few = windows.filter("trial not in (4, 5)") if seconds < 7 else windows
    joined = J.samples_in_windows(busy, few, bin_seconds=seconds)
    assert joined.columns == ["number", "date_time", "trial", "start_time", "end_time"]
    assert sorted((r.number, r.trial) for r in joined.collect()) == brute_force(busy, few)


def test_a_busy_day_is_many_keys(busy, windows):
    seconds = J.window_bin_seconds(windows)
    joined = J.samples_in_windows(busy, windows, bin_seconds=seconds)
    assert sorted((r.number, r.trial) for r in joined.collect()) == brute_force(busy, windows)
    plan = plan_of(joined)
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "_bin" in plan
    keys = busy.filter(F.to_date("date_time") == F.lit(T0.date())).select(F.floor(J.wall_seconds("date_time") / seconds))
    assert keys.distinct().count() >= 4
    # rows of the windows' side stay in proportion to the windows
    valid = windows.filter("start_time < end_time").count()
    rows = J.window_bins(windows, "start_time", "end_time", "_day", "_bin", seconds).count()
    days = J.window_days(windows, "start_time", "end_time", "_day").count()
    assert rows <= 10 * valid + days


def test_bin_width_without_windows(spark, windows):
    assert J.window_bin_seconds(windows.limit(0)) == 86_400
    assert J.window_bin_seconds(windows.filter("trial in (6, 7, 8)")) == 86_400
    with pytest.raises(ValueError):
        J.samples_in_windows(windows, windows, bin_seconds=0)


def test_stored_day_and_bins_together(busy, windows):
    stored = busy.withColumn("sample_date", F.to_date("date_time"))
    joined = J.samples_in_windows(stored, windows, day="sample_date", bin_seconds=1000)
    assert sorted((r.number, r.trial) for r in joined.collect()) == brute_force(busy, windows)


def test_legacy_means_by_bins(spark):
    samples = spark.createDataFrame(
        [("p", n, at(600 * i), float(i + n)) for n in (1, 2) for i in range(100)],
        "point_name string, logger_number int, date_time timestamp_ntz, intensity_lum_ft2 double",
    )
    windows = spark.createDataFrame(
        [(at(0), at(5000)), (at(4000), at(30_000))], "start_time timestamp_ntz, end_time timestamp_ntz"
    )
    plain, binned = (
        sorted(tuple(r) for r in paired_window_means(samples, windows, on=(), bin_seconds=b).collect()) for b in (None, 900)
    )
    assert plain == binned and len(plain) == 2


# --- buckets ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    data = [(f"f{f}", n, at(3600 * n), 60.0 + n, float(n), False) for f in range(6) for n in range(60)]
    samples = spark.createDataFrame(
        data, "file_path string, number int, date_time timestamp_ntz, temp_f double, intensity_lum_ft2 double, is_event boolean"
    )
    path = str(tmp_path_factory.mktemp("buckets") / "samples")
    TB.save_bucketed_samples(samples, "bucketed_samples", path, buckets=8)
    yield samples, path
    spark.sql("drop table if exists bucketed_samples")


def without_broadcast(spark, make):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = make()
        return plan_of(df), sorted(map(str, df.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def loggers(spark):
    return spark.createDataFrame(
        [("f1", at(0), at(90_000)), ("f2", at(100), at(5000)), ("gone", at(0), at(10))],
        "file_path string, start_time timestamp_ntz, end_time timestamp_ntz",
    )


def test_bucketed_samples_meet_windows_without_a_shuffle(spark, stored):
    samples, _ = stored
    table = TB.load_bucketed(spark, "bucketed_samples")

    def join(df):
        return lambda: J.samples_in_windows(df, loggers(spark), ["file_path"], day=TB.SAMPLE_DAY)

    plan, rows = without_broadcast(spark, join(table))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1  # the windows' side
    day = samples.withColumn(TB.SAMPLE_DAY, F.to_date("date_time"))
    other, plain = without_broadcast(spark, join(day.select(*table.columns)))
    assert rows == plain and len(rows) > 10
    assert len(re.findall(r"Exchange hashpartitioning", other)) == 2


def test_bucketed_samples_aggregate_without_a_shuffle(spark, stored):
    samples, _ = stored
    table = TB.load_bucketed(spark, "bucketed_samples")
    days = table.groupBy("file_path", TB.SAMPLE_DAY, "number").count()
    assert "Exchange" not in plan_of(days)
    assert days.count() == samples.count()


def test_one_file_per_bucket_and_new_sessions(spark, stored, tmp_path):
    samples, path = stored
    # what another session sees: only the folder
    other = spark.newSession()
    other.sql("drop table if exists found_samples")
    table = TB.register_bucketed(other, "found_samples", path, TB.SAMPLE_BUCKETS, 8, TB.SAMPLE_ORDER)
    assert table.count() == samples.count()
    assert "Exchange" not in plan_of(table.groupBy(*TB.SAMPLE_BUCKETS).count())
    parts = spark.read.parquet(path).select(F.col("_metadata.file_name").alias("f")).distinct().count()
    assert parts <= 8
    other.sql("drop table found_samples")
    assert spark.read.parquet(path).count() == samples.count()
