import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from plan_text import plan_of
from turbilux.operators import cells as C
from turbilux.operators import extent as X
from turbilux.operators import joins as J
from turbilux.operators import pairing as P
from turbilux.operators import reshape as R
from turbilux.operators import rolling as O
from turbilux.operators import rows as W

NAN, INF = float("nan"), float("inf")
T0 = dt.datetime(2022, 9, 25, 9, 0)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


# --- joins ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def hot_samples(spark):
    """One file holds most of the samples."""
    data = [("hot", n, at(20 * n)) for n in range(600)] + [(f"f{i}", n, at(20 * n)) for i in range(5) for n in range(20)]
    return spark.createDataFrame(data, "file_path string, number int, date_time timestamp_ntz")


@pytest.fixture(scope="module")
def windows(spark):
    midnight = dt.datetime(2022, 9, 26)
    data = [
        ("hot", 1, at(0), at(400)),
        ("hot", 2, at(200), at(600)),  # overlaps the first
        ("hot", 3, midnight - dt.timedelta(hours=20), midnight + dt.timedelta(hours=1)),  # two days
        ("f1", 1, at(40), at(40)),  # empty
        ("f2", 1, at(100), at(60)),  # backwards
        ("f3", 1, at(40), at(100)),
        ("f4", 1, None, at(100)),
        ("gone", 1, at(0), at(100)),
    ]
    return spark.createDataFrame(data, "file_path string, trial int, start_time timestamp_ntz, end_time timestamp_ntz")


def brute_force(samples, windows):
    all_windows = windows.collect()
    return sorted(
        (s.file_path, s.number, w.trial)
        for s in samples.collect()
        for w in all_windows
        if s.file_path == w.file_path and w.start_time and w.start_time <= s.date_time < w.end_time
    )


def test_samples_in_windows(hot_samples, windows):
    joined = J.samples_in_windows(hot_samples, windows, ["file_path"])
    got = sorted((r.file_path, r.number, r.trial) for r in joined.collect())
    assert got == brute_force(hot_samples, windows)
    plan = plan_of(joined)
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_lookup_join_keeps_every_fact_once(spark, hot_samples):
    lookup = spark.createDataFrame([("hot", "a"), ("f1", "b"), ("f1", "c")], "file_path string, tag string")
    left = J.lookup_join(hot_samples, lookup, ["file_path"], "left")
    counts = {r.tag: r["count"] for r in left.groupBy("tag").count().collect()}
    assert counts == {"a": 600, "b": 20, "c": 20, None: 80}
    inner = J.lookup_join(hot_samples, lookup, ["file_path"])
    assert inner.count() == 640
    with pytest.raises(ValueError):
        J.lookup_join(hot_samples, lookup, ["file_path"], "full")


def test_hot_key_is_split_at_run_time(spark, tmp_path):
    """The shuffle variant with a key that holds most rows, thresholds lowered to test size."""
    hot = spark.range(200_000, numPartitions=8).select(
        F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("f"), F.col("id") % 500)).alias("file_path"),
        F.col("id").alias("number"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    lookup = spark.range(501).select(
        F.when(F.col("id") == 500, "hot").otherwise(F.concat(F.lit("f"), F.col("id"))).alias("file_path"), F.col("id").alias("tag")
    )
    changed = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "500KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        joined = J.lookup_join(hot, lookup, ["file_path"])
        rows_, _ = joined.count(), joined.collect()
        assert rows_ == 200_000
        assert "skew=true" in plan_of(joined)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_problem_and_coordinate_joins(spark):
    day = dt.date(2022, 10, 1)
    trials = spark.createDataFrame([("A", day, 1, 5.0), ("B", day, 1, 6.0)], "point_name string, date date, disturbance_number int, m double")
    problems = spark.createDataFrame([(day, "A", 1, "eel"), (day, "B", 2, "crab")], "date date, pole_id string, disturbance int, problem string")
    assert {r.point_name: r.problem for r in J.join_problem_poles(trials, problems).collect()} == {"A": "eel", "B": None}
    coords = spark.createDataFrame(
        [("A", day, 1, 1.0, 2.0), ("A", day, 1, 1.5, 2.0), ("b", day, 1, 3.0, 4.0)],
        "point_name string, date date, disturbance_id int, coord_x double, coord_y double",
    )
    placed = J.join_coordinates(trials, coords)
    assert sorted((r.point_name, r.coord_x) for r in placed.filter("coord_x is not null").collect()) == [("A", 1.0), ("A", 1.5)]
    assert placed.filter("coord_x is null").count() == 1  # names are compared as written


def test_disturbance_join_keeps_quiet_days(spark):
    dep = spark.createDataFrame([("A", dt.date(2022, 10, 1)), ("A", dt.date(2022, 10, 2))], "point_name string, date date")
    dist = spark.createDataFrame([(dt.date(2022, 10, 1), 1), (dt.date(2022, 10, 1), 2)], "date date, disturbance_number int")
    assert J.join_disturbances(dep, dist).count() == 3


# --- pairing -------------------------------------------------------------------------

SAMPLES = "trial int, logger_number int, number int, date_time timestamp_ntz, intensity double"


def test_pairing_by_join_and_by_aggregation_agree(spark):
    rng = random.Random(7)
    data = [
        (trial, logger, n, at(20 * n + (trial == 2 and n > 30)), rng.choice([0.0, 1.5, 7.0, None]))
        for trial in (1, 2, 3)
        for logger in (1, 2, 3)
        for n in range(60)
        if rng.random() < 0.8
    ]
    samples = spark.createDataFrame(data, SAMPLES)
    sides = [samples.filter(F.col("logger_number") == n).drop("logger_number") for n in (1, 2)]
    joined = P.pair_loggers(*sides, within=["trial"])
    grouped = P.pair_samples(samples, ["trial", "number", "date_time"], ["intensity"])
    keys = ["trial", "number"]
    assert rows(joined.select("trial", "number", "intensity_1", "intensity_2"), *keys) == rows(
        grouped.select("trial", "number", "intensity_1", "intensity_2"), *keys
    )
    report = {r.trial: (r.unpaired_top, r.unpaired_bottom, r.pairs) for r in P.pairing_report(samples, ["trial"]).collect()}
    for trial in (1, 2, 3):
        top = {(n, t) for x, lg, n, t, _ in data if x == trial and lg == 1}
        bottom = {(n, t) for x, lg, n, t, _ in data if x == trial and lg == 2}
        assert report[trial] == (len(top - bottom), len(bottom - top), len(top & bottom))
    means = {r.trial: r.light_attenuation_mean for r in P.mean_attenuation(joined, ["trial"], "intensity", "skip").collect()}
    for trial in (1, 2, 3):
        pct = [100 * (a - b) / a for x, _, a, b in rows(joined.select("trial", "number", "intensity_1", "intensity_2"), *keys) if x == trial and a and b is not None]
        assert math.isclose(means[trial], sum(pct) / len(pct))


def test_inserted_event_shifts_pairs(spark):
    """An extra row in one file shifts its ordinals: later samples pair by time only."""
    top = spark.createDataFrame([(n, at(20 * n), 1.0) for n in range(10)], "number int, date_time timestamp_ntz, v double")
    shifted = [(n if n < 5 else n + 1, at(20 * n), 1.0) for n in range(10)]
    bottom = spark.createDataFrame(shifted, "number int, date_time timestamp_ntz, v double")
    assert P.pair_loggers(top, bottom).count() == 5
    assert P.pair_loggers(top.drop("number"), bottom.drop("number"), keys=["date_time"]).count() == 10


def test_repeated_key_fails_or_averages(spark):
    data = [(1, 1, 1, T0, 2.0), (1, 1, 1, T0, 4.0), (1, 2, 1, T0, 1.0)]
    samples = spark.createDataFrame(data, SAMPLES)
    keys = ["trial", "number", "date_time"]
    with pytest.raises(Exception, match="more than one row"):
        P.pair_samples(samples, keys, ["intensity"]).collect()
    assert P.pair_samples(samples, keys, ["intensity"], cell="mean").first()["intensity_1"] == 3.0


def test_mean_attenuation_keeps_infinity_and_skips_nan(spark):
    pairs = spark.createDataFrame(
        [(1, 10.0, 5.0), (1, 0.0, 0.0), (2, 0.0, 5.0), (2, 1.0, 1.0), (3, 0.0, 5.0), (3, 0.0, -5.0), (4, None, 1.0)],
        "trial int, v_1 double, v_2 double",
    )
    assert rows(P.mean_attenuation(pairs, ["trial"], "v"), "trial") == [(1, 50.0), (2, -INF), (3, None), (4, None)]


def test_full_outer_pairing(spark):
    one = spark.createDataFrame([("A", T0, 1.0), ("B", T0, None)], "point_name string, start_time timestamp_ntz, logger_1_intensity double")
    two = spark.createDataFrame([("A", T0, 2.0), ("B", T0, 3.0), ("C", T0, None)], "point_name string, start_time timestamp_ntz, logger_2_intensity double")
    assert rows(P.full_outer_pairing(one, two), "point_name") == [("A", T0, 1.0, 2.0), ("B", T0, None, 3.0)]


# --- reshape -------------------------------------------------------------------------


def test_pivot_then_unpivot_is_identity(spark):
    data = [("A", 1, "a1", 1.0), ("A", 2, "a2", None), ("B", 3, "b3", 3.0)]
    df = spark.createDataFrame(data, "point string, logger_number_per_pole int, path string, v double")
    wide = R.pivot_loggers(df, ["point"], ["path", "v"])
    assert [c for c in wide.columns if c.startswith("path")] == ["path_1", "path_2", "path_3"]
    back = R.unpivot_loggers(wide.drop("n_1", "n_2", "n_3"), ["path", "v"], numbers=(1, 2, 3)).filter("path is not null")
    assert rows(back.select("point", F.col("logger_id").cast("int"), "path", "v"), "path") == data


def test_crowded_pivot_cell_fails(spark):
    df = spark.createDataFrame([("A", 1, "x"), ("A", 1, "y")], "point string, logger_number_per_pole int, path string")
    with pytest.raises(Exception, match="more than one row"):
        R.pivot_loggers(df, ["point"], ["path"]).collect()
    assert R.pivot_loggers(df.limit(1), ["point"], ["path"]).count() == 1


def test_border_split(spark):
    data = [(1, 50.0, 25.0), (2, 100.0, 25.0), (3, 100.0, 50.0), (4, 96.5, 203.4), (5, 300.0, 200.0), (6, None, 0.0)]
    df = spark.createDataFrame(data, "id int, coord_x double, coord_y double")
    split = R.split_on_borders(df)
    counts = {r.id: r["count"] for r in split.groupBy("id").count().collect()}
    assert counts == {1: 1, 2: 2, 3: 4, 4: 2, 5: 4, 6: 2}
    assert sorted((r.coord_x, r.coord_y) for r in split.filter("id = 3").collect()) == [
        (96.5, 46.5), (96.5, 53.5), (103.5, 46.5), (103.5, 53.5),
    ]
    assert {(r.coord_x, r.coord_y) for r in W.clip_to_site(split).filter("id = 5").collect()} == {(296.5, 196.5)}
    legacy = R.split_on_borders(df, fudge=1.0, shift=2.0)
    assert sorted(r.coord_x for r in legacy.filter("id = 2").collect()) == [98.0, 102.0]


def test_bind_rows_and_arrange(spark):
    a = spark.createDataFrame([(2, "x"), (None, "y")], "n int, s string")
    b = spark.createDataFrame([(1,), (2,)], "n int")
    assert [tuple(r) for r in R.arrange(R.bind_rows(a, b), "n", "s").collect()] == [(1, None), (2, "x"), (2, None), (None, "y")]


# --- rows ----------------------------------------------------------------------------


def test_event_rows_and_null_columns(spark):
    data = [(1, 5.0, None, None), (2, None, "Logged", None), (3, 6.0, "Logged", None), (4, None, None, None), (5, NAN, None, None)]
    df = spark.createDataFrame(data, "n int, v double, button_down string, stopped string")
    quiet = W.drop_event_rows(df)
    assert sorted(r.n for r in quiet.collect()) == [1, 4, 5]
    kept = W.drop_all_null_columns(quiet)
    assert kept.columns == ["n", "v"]
    assert [r.n for r in W.drop_any_null_rows(kept).collect()] == [1]
    flagged = df.select("n", (F.col("n") == 2).alias("is_event"))
    assert W.drop_event_rows(flagged).count() == 4


def test_filters(spark):
    day = dt.date
    df = spark.createDataFrame(
        [(day(2022, 6, 3), "p/a", None, "1"), (day(2022, 11, 9), "p/deprecated/b", None, "U"), (day(2022, 7, 14), "p/c", "bad", "2"), (None, None, None, None)],
        "date date, path string, data_issue string, track string",
    )
    assert W.exclude_dates(df, ["2022-06"]).count() == 2
    assert W.exclude_dates(df, ["2022-06", "2022-11-09"]).count() == 1
    assert W.exclude_matching(df, "path", "deprecated").count() == 2
    issue_free = W.exclude_flagged(df)
    assert issue_free.count() == 3 and "data_issue" not in issue_free.columns
    assert W.require_present(df, "path").count() == 3
    assert [r.path for r in W.prefix_path(df, "path").filter("date = date'2022-07-14'").collect()] == ["../p/c"]
    assert W.exclude_unclassified(df, "track").count() == 2
    assert W.equals(df, date=day(2022, 7, 14), track="2").count() == 1
    assert W.drop_prefixed(df, "data", "tr").columns == ["date", "path"]
    assert W.drop_na(df, "track").count() == 3
    assert rows(W.unique_dates(df), "date") == [(day(2022, 6, 3), 1), (day(2022, 7, 14), 2), (day(2022, 11, 9), 3)]


# --- extent --------------------------------------------------------------------------


def test_file_extent(spark):
    data = [("a", n, at(20 * n)) for n in range(1, 6)] + [("two", 1, at(0)), ("two", 9, at(99)), ("one", 1, at(0))]
    df = spark.createDataFrame(data, "file_path string, number int, date_time timestamp_ntz")
    assert rows(X.file_extent(df), "file_path") == [
        ("a", at(20), at(80), 20.0),
        ("one", None, None, None),
        ("two", at(0), at(0), None),
    ]
    assert rows(X.file_extent(df, drop_last=False), "file_path") == [
        ("a", at(20), at(100), 20.0),
        ("one", at(0), at(0), None),
        ("two", at(0), at(99), 99.0),
    ]
    kept = X.drop_last_row(df, ["file_path"], ["number"])
    assert sorted((r.file_path, r.number) for r in kept.collect()) == [("a", 1), ("a", 2), ("a", 3), ("a", 4), ("two", 1)]


def test_file_extent_trims_rows_before_the_shuffle(spark, hot_samples):
    plan = plan_of(X.file_extent(hot_samples))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_harmonised_extent_is_missing_when_a_file_has_none(spark):
    data = [("A", at(0), at(100), 20.0), ("A", at(10), at(90), 10.0), ("B", at(0), at(9), 1.0), ("B", None, None, None)]
    df = spark.createDataFrame(data, "point_name string, first_date_time timestamp_ntz, last_date_time timestamp_ntz, measurement_interval double")
    over = X.harmonise_extent(df, ["point_name"])
    expected = {("A", at(10), at(90), 10.0), ("B", None, None, None)}
    assert {tuple(r) for r in over.collect()} == expected
    assert over.count() == 4
    assert {tuple(r) for r in df.groupBy("point_name").agg(*X.common_extent()).collect()} == expected


# --- rolling -------------------------------------------------------------------------


def brute_rolling(series, k):
    before, after = (k - 1) // 2, k // 2
    out = []
    for i in range(len(series)):
        frame = series[i - before : i + after + 1] if i >= before else []
        out.append(sum(frame) / k if len(frame) == k and None not in frame else None)
    return out


@pytest.fixture(scope="module")
def series(spark):
    rng = random.Random(3)
    data = []
    for s, length in (("long", 230), ("short", 3), ("gaps", 90)):
        number = 0
        for _ in range(length):
            number += rng.choice([1, 1, 1, 40]) if s == "gaps" else 1
            data.append((s, number, None if rng.random() < 0.02 else float(rng.randint(0, 50))))
    return data, spark.createDataFrame(data, "s string, number int, v double").repartition(8)


def check_rolled(data, rolled, k_of):
    got = {(r.s, r.number): r.v_rollmean for r in rolled.collect()}
    assert len(got) == len(data) == rolled.count()
    for s in ("long", "short", "gaps"):
        mine = [(n, v) for x, n, v in data if x == s]
        for (n, _), want in zip(mine, brute_rolling([v for _, v in mine], k_of(s))):
            have = got[(s, n)]
            assert (have is None) == (want is None) and (want is None or math.isclose(have, want, abs_tol=1e-9)), (s, n)


@pytest.mark.parametrize("k", [1, 2, 5, 16])
def test_rolling_mean_fixed_width(series, k):
    data, df = series
    check_rolled(data, O.centered_rolling_mean(df, ["v"], k, by=["s"], order=["number"]), lambda s: k)
    # chunks of 10 ordinals and blocks of 16 rows: windows reach over many cuts
    blocked = O.blocked_rolling_mean(
        df, ["v"], k, by=["s"], order=["number"], chunk=F.floor(F.col("number") / 10), block_rows=16
    )
    check_rolled(data, blocked, lambda s: k)


def test_rolling_mean_width_per_series(series):
    data, df = series
    widths = {"long": 16, "short": 2, "gaps": 7}
    k = F.when(F.col("s") == "long", 16).when(F.col("s") == "short", 2).otherwise(7)
    wide = df.withColumn("k", k)
    check_rolled(data, O.centered_rolling_mean(wide, ["v"], "k", by=["s"], order=["number"]), widths.get)
    blocked = O.blocked_rolling_mean(
        wide, ["v"], "k", by=["s"], order=["number"], chunk=F.floor(F.col("number") / 10), block_rows=20
    )
    check_rolled(data, blocked, widths.get)


def test_even_window_reaches_ahead(spark):
    df = spark.createDataFrame([("a", n, float(n)) for n in range(1, 31)], "s string, number int, v double")
    rolled = rows(O.centered_rolling_mean(df, ["v"], 16, by=["s"], order=["number"]), "number")
    assert [r[1] for r in rolled if r[3] is not None] == list(range(8, 23))
    assert rolled[7][3] == 8.5


def test_rolling_mean_of_odd_values_and_widths(spark):
    inf = float("inf")
    data = [("a", n, v, 2) for n, v in enumerate([1.0, inf, 2.0, 0.0, 0.0, float("nan"), 3.0, -inf, 5.0, 7.0])]
    data += [("none", n, 1.0, None) for n in range(3)] + [("zero", n, 1.0, 0) for n in range(3)]
    df = spark.createDataFrame(data, "s string, number int, v double, k int")
    want = [inf, inf, 1.0, 0.0, None, None, -inf, -inf, 6.0, None] + [None] * 6
    plain = O.centered_rolling_mean(df, ["v"], "k", by=["s"], order=["number"])
    blocked = O.blocked_rolling_mean(
        df, ["v"], "k", by=["s"], order=["number"], chunk=F.floor(F.col("number") / 3), block_rows=2
    )
    for rolled in (plain, blocked):
        assert [r.v_rollmean for r in rolled.orderBy("s", "number").collect()] == want
        assert rolled.columns == [*df.columns, "v_rollmean"]


def test_positions_without_sorting_a_whole_series(spark):
    df = spark.createDataFrame([("a", n * n) for n in range(100)], "s string, number int").repartition(7)
    placed = O.series_positions(df, ["s"], ["number"], F.floor(F.col("number") / 500))
    assert [r._position for r in placed.orderBy("number").collect()] == list(range(100))


# --- cells ---------------------------------------------------------------------------


def test_rollups(spark):
    d1, d2 = dt.date(2022, 10, 1), dt.date(2022, 10, 5)
    data = [
        (d1, 1, "1", "A", 10.0), (d1, 1, "1", "A", 20.0), (d1, 2, "1", "A", 60.0), (d1, 2, "1", "A", 40.0),
        (d1, 1, "2", "A", -5.0), (d1, 1, "U", "A", 3.0), (d2, 1, "1", "A", 1.0), (d2, 1, "3", "B", NAN),
        (d2, 2, "3", "B", INF),
    ]
    df = spark.createDataFrame(data, "date date, disturbance_number int, track string, zone string, light_attenuation_mean double")
    cells = C.cell_stats(df)
    got = {tuple(r)[:4]: tuple(r)[4:] for r in cells.collect()}
    assert set(got) == {(d1, 1, "1", "A"), (d1, 2, "1", "A"), (d1, 1, "U", "A"), (d2, 1, "1", "A"), (d2, 2, "3", "B")}
    assert got[(d1, 1, "1", "A")] == (15.0, pytest.approx(math.sqrt(50)), 2, 30.0)
    assert got[(d2, 1, "1", "A")] == (1.0, None, 1, 1.0)
    assert got[(d2, 2, "3", "B")][0] == INF
    assert C.cell_stats(df, min_mean=None).count() == 7

    means = {tuple(r)[:3]: tuple(r)[3:] for r in C.day_mean(cells).collect()}
    assert means[(d1, "1", "A")] == (32.5, pytest.approx(math.sqrt(2) * (math.sqrt(200) - math.sqrt(50)) / 2), 2)
    sums = {tuple(r)[:3]: tuple(r)[3:] for r in C.day_sum(cells).collect()}
    assert sums[(d1, "1", "A")][2:] == (4, 130.0)
    assert sum(v[2] for v in sums.values()) == cells.agg(F.sum("n")).first()[0]
    whole = {tuple(r)[:2]: tuple(r)[2:] for r in C.experiment_mean(cells).collect()}
    assert whole[("1", "A")][0] == pytest.approx((32.5 + 1.0) / 2)
    assert ("U", "A") in whole


def test_replicates_and_range(spark):
    df = spark.createDataFrame([("A", 1.0), ("A", NAN), ("A", 5.0), ("B", None)], "point_name string, light_attenuation_mean double")
    assert rows(C.replicate_mean(df, ["point_name"]), "point_name") == [("A", 3.0), ("B", None)]
    assert tuple(C.global_range(df).first()) == (1.0, 5.0)


def test_points_in_cells_counts_borders_inclusively(spark):
    df = spark.createDataFrame([(100.0, 50.0), (10.0, 10.0), (300.0, 200.0), (-1.0, 10.0), (None, 10.0)], "coord_x double, coord_y double")
    counts = {(r.x, r.y): r.cnt for r in C.points_in_cells(df).collect()}
    assert len(counts) == 9
    assert counts[(1, 1)] == 2 and counts[(2, 1)] == 1 and counts[(1, 2)] == 1 and counts[(2, 2)] == 1
    assert counts[(3, 3)] == 1 and counts[(3, 1)] == 0
    plan = plan_of(C.points_in_cells(df))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_snapped_counts_and_grid(spark):
    df = spark.createDataFrame([(49.0, 51.0), (50.0, 149.0), (150.0, 0.0)], "coord_x double, coord_y double")
    assert {tuple(r) for r in C.count_by_snapped(df).collect()} == {(0.0, 100.0, 2), (200.0, 0.0, 1)}
    grid = C.grid(spark)
    assert grid.count() == 16
    tiles = C.with_tile_bounds(W.exclude_unclassified(grid))
    assert tiles.count() == 9
    assert {(r.track, r.zone): (r.xmin, r.ymax) for r in tiles.collect()}[("3", "C")] == (2.5, 4.5)


def test_blocks_keep_rows_without_order_or_key(spark):
    rows = [("a", i if i != 5 else None, float(i)) for i in range(21)] + [(None, i, float(i)) for i in range(9)]
    df = spark.createDataFrame(rows, "s string, n int, v double")
    plain = O.centered_rolling_mean(df, ["v"], 3, by=["s"], order=["n"])
    blocked = O.blocked_rolling_mean(df, ["v"], 3, by=["s"], order=["n"], chunk=F.floor(F.col("n") / 4), block_rows=4)
    key = lambda r: (r.s or "", -1 if r.n is None else r.n)
    assert [tuple(r) for r in sorted(plain.collect(), key=key)] == [tuple(r) for r in sorted(blocked.collect(), key=key)]


def test_file_without_one_sensor_keeps_its_extent(spark):
    from turbilux.plans.pole_trials import sample_extents

    start = dt.datetime(2022, 9, 25, 8)
    rows = []
    for name in ("both", "dark", "gap"):
        for i in range(5):
            light = None if name == "dark" or (name == "gap" and i == 0) else 10.0
            rows.append((name, i, start + dt.timedelta(seconds=20 * i), 70.0, light, False))
    samples = spark.createDataFrame(
        rows, "file_path string, number int, date_time timestamp_ntz, temp_f double, intensity_lum_ft2 double, is_event boolean"
    )
    got = {r.file_path: r for r in sample_extents(samples).collect()}
    assert set(got) == {"both", "dark", "gap"}
    assert got["dark"].first_date_time == got["both"].first_date_time == start
    assert got["dark"].measurement_interval == 20
    # a value missing in a recorded sensor still drops the row
    assert got["gap"].first_date_time == start + dt.timedelta(seconds=20)
    used = spark.createDataFrame([("dark",)], "lightlogger_file_path string")
    assert [r.file_path for r in sample_extents(samples, used).collect()] == ["dark"]
