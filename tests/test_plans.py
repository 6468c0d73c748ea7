"""The whole study on small hand-made files, against a plain Python recomputation."""

import csv
import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from logger_writer import LAYOUTS, write_logger_file
from turbilux.operators.pairing import full_outer_pairing
from turbilux.operators.reshape import bind_rows
from turbilux.plans import legacy, site_tables
from turbilux.plans.pole_trials import pole_trials, trial_loggers, usable_deployments
from turbilux.plans.trial_series import trial_series
from turbilux.sources.logger_files import read_samples
from turbilux.sources.metadata import (
    COORDINATE_TYPES,
    DEPLOYMENT_TYPES,
    read_disturbances,
    read_metadata,
    read_problem_poles,
)
from turbilux.sources.tables import load_table, save_table, stage

DAYS = [dt.date(2022, 6, 3), dt.date(2022, 9, 25), dt.date(2022, 11, 9)]
POLES = ["A", "B", "C", "d"]
TRIALS = {1: ("9:10", "9:20"), 2: ("9:30", "9:41:30")}
STEP = 20


def light_series(rng, day, length=180):
    """9:00 to 10:00 in steps of 20 s, with zero light, gaps in the ordinals and events."""
    rows, number = [], 0
    start = dt.datetime.combine(day, dt.time(9, 0))
    shift_at = rng.choice([None, 100])
    for i in range(length):
        number += 1
        t = start + dt.timedelta(seconds=STEP * i)
        if i == shift_at:
            rows.append((number, t - dt.timedelta(seconds=5), None, None, "End Of File"))
            number += 1
        light = 0.0 if rng.random() < 0.03 else round(rng.uniform(1, 90), 2)
        rows.append((number, t, round(rng.uniform(70, 90), 2), light, None))
    rows.append((number + 1, t + dt.timedelta(seconds=7), None, None, "End Of File"))
    return rows


@pytest.fixture(scope="module")
def study(spark, tmp_path_factory):
    rng = random.Random(11)
    home = tmp_path_factory.mktemp("study")
    (home / "logs").mkdir()
    files, deployments = {}, []
    for d, day in enumerate(DAYS):
        for p, pole in enumerate(POLES):
            for logger in (1, 2, 3):
                if (pole, logger) == ("C", 2) or (logger == 3 and pole != "A"):
                    continue
                sn = f"{20 + d}{p}{logger}"
                name = f"{sn}_{day}_export.csv"
                rows = light_series(rng, day)
                files[(day, pole, logger)] = rows
                # full seconds only: minute stamps are covered by the source tests
                write_logger_file(home / "logs" / name, sn, rows, LAYOUTS[0] if d % 2 else LAYOUTS[2])
                note = "na" if logger == 1 else f"note {sn}"
                deployments.append([day, pole, logger, f"logs/{name}", name, note, "wet" if (d, pole) == (2, "B") and logger == 1 else ""])
    deployments.append([DAYS[1], "A", 2, "logs/deprecated/old.csv", "old.csv", "", ""])
    deployments.append([DAYS[1], "B", 3, "na", "none.csv", "", ""])

    def sheet(name, header, rows):
        with open(home / name, "w", newline="") as f:
            csv.writer(f).writerows([header, *rows])
        return str(home / name)

    dep = sheet(
        "deployments.csv",
        "date point_name logger_number_per_pole lightlogger_file_path lightlogger_file_name notes data_issue".split(),
        deployments,
    )
    dist = sheet("disturbances.csv", "date disturbance_number start_time end_time".split(), [[d, n, *t] for d in DAYS for n, t in TRIALS.items()])
    prob = sheet("problems.csv", "date pole_id disturbance problem".split(), [[DAYS[1], "A", 2, "eel"]])
    coord_rows = []
    for day in DAYS:
        for n in TRIALS:
            coord_rows += [
                [day, n, 1, "x", 50, 25, "na", "na", "na", "na", ""],
                [day, n, 1, "a", 100, 50, "na", "na", 0, 0, ""],
                [day, n, 1, "a", 100, 50, "na", "na", 0, 0, ""],  # one row per logger: must not count twice
                [day, n, 1, "b", "na", 25, 90, 30, 40, 25, ""],
                [day, n, 2, "c", 10, 10, "na", "na", "na", "na", ""],
                [day, n, 2, "d", 250, "?", 30, 60, 250, 80, ""],
            ]
    header = "date disturbance_id line_id point_name coord_x coord_y angle_degrees distance_from_disturbance_ft reference_coord_x reference_coord_y".split()
    coords = sheet("coordinates.csv", [*header, ""], coord_rows)

    samples = read_samples(spark, str(home / "logs"))
    prefix = samples.select(F.regexp_extract("file_path", "^(.*/)logs/", 1)).first()[0]
    frames = {
        "deployments": usable_deployments(read_metadata(spark, dep, DEPLOYMENT_TYPES), prefix),
        "samples": samples,
        "disturbances": read_disturbances(spark, dist),
        "problems": read_problem_poles(spark, prob),
        "coordinates": site_tables.coordinates(read_metadata(spark, coords, COORDINATE_TYPES)),
    }
    store = str(home / "samples")
    save_table(samples, store)
    frames["samples"] = load_table(spark, store)
    return frames, files


@pytest.fixture(scope="module")
def trials(study):
    frames, _ = study
    return stage(
        pole_trials(frames["deployments"], frames["samples"], frames["disturbances"], frames["problems"])
    )


def window(day, n, pad=0):
    start, end = (dt.datetime.combine(day, dt.time(*map(int, t.split(":")))) for t in TRIALS[n])
    return start - dt.timedelta(minutes=pad), end + dt.timedelta(minutes=pad)


def pairs_of(files, day, pole, n, pad=0):
    start, end = window(day, n, pad)
    one, two = ({(r[0], r[1]): (r[2], r[3]) for r in files[(day, pole, lg)] if start <= r[1] < end} for lg in (1, 2))
    return [(k, one[k], two[k]) for k in sorted(one) if k in two]


def pct(a, b):
    if a is None or b is None or (a == 0 and a == b):
        return None
    return 100 * (a - b) / a if a else math.copysign(math.inf, a - b)


def mean_of(values):
    values = [v for v in values if v is not None]
    return sum(values) / len(values) if values else None


def close(a, b):
    return (a is None) == (b is None) and (a is None or a == b or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9))


def usable_poles(day):
    return [p for p in POLES if p != "C" and not (day == DAYS[2] and p == "B")]


def test_pole_trials(study, trials):
    _, files = study
    got = {(r.date, r.point_name, r.disturbance_number): r for r in trials.collect()}
    assert set(got) == {(d, p, n) for d in DAYS[1:] for p in POLES for n in TRIALS}
    assert trials.count() == len(got)
    for (day, pole, n), r in got.items():
        means = [pct(a[1], b[1]) for _, a, b in pairs_of(files, day, pole, n)] if pole in usable_poles(day) else []
        assert close(r.light_attenuation_mean, mean_of(means)), (day, pole, n)
        assert r.problem == ("eel" if (day, pole, n) == (DAYS[1], "A", 2) else None)
        assert (r.lightlogger_file_path_2 is None) == (pole == "C")
        assert (r.lightlogger_file_path_3 is not None) == (pole == "A")
        assert r.notes_1 is None
        loggers = [k for k in files if k[:2] == (day, pole) and not (day == DAYS[2] and pole == "B" and k[2] == 1)]
        firsts, lasts, steps = [], [], []
        for k in loggers:
            clean = [x for x in files[k] if x[4] is None][:-1]
            firsts.append(clean[0][1])
            lasts.append(clean[-1][1])
            steps.append((clean[-1][1] - clean[0][1]).total_seconds() / (len(clean) - 1))
        assert (r.first_date_time, r.last_date_time) == (max(firsts), min(lasts))
        assert close(r.measurement_interval, min(steps))
        assert close(r.sliding_window_width, 300 / min(steps) + 1)


def test_pairing_by_time_alone(study):
    frames, files = study
    trials = pole_trials(
        frames["deployments"], frames["samples"], frames["disturbances"], frames["problems"],
        pair_keys=("date_time",), excluded_dates=(), zero_light="skip",
    )
    for r in trials.filter("light_attenuation_mean is not null").collect():
        start, end = window(r.date, r.disturbance_number)
        one, two = ([x for x in files[(r.date, r.point_name, lg)] if start <= x[1] < end] for lg in (1, 2))
        want = mean_of([pct(a[3], b[3]) for a in one if a[3] for b in two if a[1] == b[1]])
        assert close(r.light_attenuation_mean, want)
    assert trials.filter(F.col("date") == DAYS[0]).count() == 8


def test_trial_series(study, trials):
    frames, files = study
    series = trial_series(trials, frames["samples"])
    got = {}
    for r in series.collect():
        got.setdefault((r.date, r.point_name, r.disturbance_number), {})[(r.number, r.logger_id)] = r
    assert set(got) == {(d, p, n) for d in DAYS[1:] for p in usable_poles(d) for n in TRIALS}
    for (day, pole, n), rows in got.items():
        pairs = pairs_of(files, day, pole, n, pad=20)
        assert len(rows) == 2 * len(pairs)
        k, before = 16, 7
        for i, (key, a, b) in enumerate(pairs):
            frame = pairs[i - before : i - before + k] if i >= before else []
            rolled = []
            for side in (1, 2):
                light = [p[side][1] for p in frame]
                rolled.append(sum(light) / k if len(light) == k and None not in light else None)
            for logger, temp_light, roll in (("1", a, rolled[0]), ("2", b, rolled[1])):
                r = rows[(key[0], logger)]
                assert (r.temp_f, r.intensity_lum_ft2) == temp_light
                assert close(r.intensity_lum_ft2_rollmean, roll)
                assert close(r.light_attenuation_pct, pct(a[1], b[1]))
                assert close(r.light_attenuation_rollmean_pct, pct(*rolled))
            assert r.title == f"{day}, Pole {pole}, Disturbance {n}"
            assert r.attenuation_on_axis is None or r.attenuation_on_axis == r.light_attenuation_pct * 100


def test_coordinates_and_segments(study):
    frames, _ = study
    coords = frames["coordinates"]
    assert "x" not in coords.columns
    points = {r.point_name: (r.coord_x, r.coord_y) for r in coords.collect()}
    assert points["B"] == (pytest.approx(40.0), pytest.approx(55.0))
    assert points["D"] == (250.0, pytest.approx(110.0))
    segments = site_tables.disturbance_segments(coords).collect()
    assert len(segments) == 2 and {r.date for r in segments} == {DAYS[1]}
    assert (segments[0].track, segments[0].zone) == ("3", "A")
    assert (segments[0].x, segments[0].xend, segments[0].y, segments[0].yend) == (2.5, 3.5, 1.5, 2.5)


@pytest.mark.parametrize("filtered", [False, True])
def test_cell_attenuation(trials, study, filtered):
    frames, _ = study
    cells = site_tables.cell_attenuation(trials, frames["coordinates"], filtered)
    # pole A stands on a corner and counts for four cells; "d" is not "D"; C has no pair
    corner = [("3", "A"), ("3", "B"), ("2", "A"), ("2", "B")]
    inputs = {}
    for r in trials.filter("light_attenuation_mean is not null").collect():
        if filtered and r.problem:
            continue
        places = corner if r.point_name == "A" else [("3", "B")] if r.point_name == "B" else []
        for place in places:
            inputs.setdefault((r.date, r.disturbance_number, *place), []).append(r.light_attenuation_mean)
    want = {k: v for k, v in inputs.items() if sum(v) / len(v) >= 0}
    got = {tuple(r)[:4]: r for r in cells.collect()}
    assert set(got) == set(want)
    for key, values in want.items():
        r = got[key]
        assert close(r.mean_light_attenuation, sum(values) / len(values)) and r.n == len(values)
        assert close(r.sum_light_attenuation, sum(values))
        sd = statistics.stdev(values) if len(values) > 1 and all(map(math.isfinite, values)) else None
        assert close(r.sd_light_attenuation, sd)


def test_lower_case_names_match_on_request(trials, study):
    frames, _ = study
    as_written, matched = (
        site_tables.gridded_poles(trials, frames["coordinates"], normalise_names=flag) for flag in (False, True)
    )
    assert as_written.filter(F.upper("point_name") == "D").count() == 0
    assert matched.filter("point_name = 'D'").count() == 2 * len(TRIALS)


def test_heatmaps_and_grid(spark, trials, study):
    frames, _ = study
    cells = stage(site_tables.cell_attenuation(trials, frames["coordinates"], min_mean=None))
    tables = site_tables.heatmaps(cells)
    assert set(tables) == {"cell_mean", "cell_sum", "day_mean", "day_sum", "experiment_mean"}
    for t in tables.values():
        assert {"fill", "label", "xmin", "xmax", "ymin", "ymax"} <= set(t.columns)
        assert t.count() > 0
    assert site_tables.grid_tiles(spark).count() == 9
    outlined = site_tables.grid_with(tables["experiment_mean"].select("track", "zone", "fill"))
    assert outlined.count() == 9 and outlined.filter("fill is not null").count() == 4


def test_pole_map(study):
    frames, _ = study
    rows = site_tables.pole_map(frames["coordinates"], date="2022-09-25").collect()
    assert {r.date for r in rows} == {DAYS[1]}
    assert [(r.disturbance_id, r.line_id) for r in rows] == sorted((r.disturbance_id, r.line_id) for r in rows)
    assert all(r.map_x == -r.coord_x for r in rows)


def test_legacy_heatmap_equals_outer_join_of_loggers(study, trials):
    frames, files = study
    both = trial_loggers(trials)
    # poles with one logger have only a first file
    lone = trials.filter("lightlogger_file_path_1 is not null and lightlogger_file_path_2 is null").select(
        "date", "point_name", "disturbance_number", "start_time", "end_time", F.lit(1).alias("logger_number"),
        F.col("lightlogger_file_path_1").alias("file_path"),
    )
    loggers = bind_rows(both, lone)
    paired = legacy.paired_window_means(frames["samples"], loggers)
    from turbilux.operators.joins import samples_in_windows
    from turbilux.operators.pairing import mean_intensity

    inside = samples_in_windows(frames["samples"], loggers, ["file_path"])
    sides = [
        mean_intensity(inside.filter(F.col("logger_number") == n), ["point_name", "start_time"]).withColumnRenamed(
            "mean_intensity", f"logger_{n}_intensity"
        )
        for n in (1, 2)
    ]
    order = ["point_name", "start_time"]
    assert [tuple(r) for r in paired.orderBy(order).collect()] == [
        tuple(r) for r in full_outer_pairing(*sides).orderBy(order).collect()
    ]
    table = legacy.legacy_pole_heatmap(paired, frames["coordinates"], date="2022-09-25").collect()
    assert {r.date for r in table} == {DAYS[1]}
    # coordinates of both disturbances match every window of the day
    assert sum(r.point_name == "B" for r in table) == 2 * 2
    one = next(r for r in table if r.point_name == "B")
    light = [mean_of([x[3] for x in files[(DAYS[1], "B", lg)] if window(DAYS[1], 1)[0] <= x[1] < window(DAYS[1], 1)[1]]) for lg in (1, 2)]
    firsts = [r for r in table if r.point_name == "B" and r.start_time == window(DAYS[1], 1)[0]]
    assert all(close(r.light_attenuation, 100 * (light[1] - light[0]) / light[0]) for r in firsts)
    assert one.map_x == -one.coord_x
