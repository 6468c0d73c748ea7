"""Repeated samples, line audit, dates by appearance, partly missing sensors: against brute force."""

import datetime as dt
import itertools
import math
import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from plan_text import plan_of
from turbilux.operators import extent as X
from turbilux.operators import pairing as P
from turbilux.operators import rows as W
from turbilux.sources import logger_files as LF

NAN, INF = float("nan"), float("inf")
T0 = dt.datetime(2022, 9, 25, 9, 0)


# --- pairing by sums ---------------------------------------------------------------------


def brute_mean(data, group, skip):
    """Mean over all pairs of a natural join, one pair at a time."""
    sides = {1: {}, 2: {}}
    for g, side, number, light in data:
        if g == group and side in sides:
            sides[side].setdefault(number, []).append(light)
    joined, total = 0, []
    for number in set(sides[1]) & set(sides[2]):
        for a, b in itertools.product(sides[1][number], sides[2][number]):
            joined += 1
            if a is None or b is None or math.isnan(a) or math.isnan(b):
                continue
            if a == 0:
                if skip or b == 0:
                    continue
                total.append(-INF if b > 0 else INF)
            elif math.isinf(a):
                continue
            else:
                total.append(100 * (a - b) / a)
    if not joined:
        return "no pair"
    if not total:
        return None
    if INF in total and -INF in total:
        return None
    return sum(total) / len(total)


@pytest.mark.parametrize("zero_light", ["ieee", "skip"])
def test_mean_over_repeated_samples_needs_no_pairs(spark, zero_light):
    rng = random.Random(11)
    lights = [0.0, 1.0, 2.5, 40.0, None, NAN, -3.0]
    data = [(rng.choice("abcd"), rng.choice([1, 2, 3]), rng.randrange(6), rng.choice(lights)) for _ in range(300)]
    data += [("one", 1, 0, 5.0), ("one", 2, 0, 4.0), ("alone", 1, 0, 5.0), ("dark", 1, 0, 0.0), ("dark", 2, 0, 0.0)]
    data += [("bright", 1, 0, 2.0), ("bright", 2, 0, 3.0), ("bright", 2, 0, 1.0)]
    df = spark.createDataFrame(data, "g string, logger_number int, number int, light double")
    got = P.mean_attenuation_of_samples(df, ["g"], ["number"], "light", zero_light)
    result = {r.g: r.light_attenuation_mean for r in got.collect()}
    expected = {g: brute_mean(data, g, zero_light == "skip") for g in {d[0] for d in data}}
    assert set(result) == {g for g, m in expected.items() if m != "no pair"}
    for g, m in result.items():
        assert m == (None if expected[g] is None else pytest.approx(expected[g], rel=1e-9, abs=1e-9)), g
    with pytest.raises(ValueError):
        P.mean_attenuation_of_samples(df, ["g"], ["number"], "light", "other")


def test_all_pairs_of_a_repeated_key(spark):
    data = [(1, 1, 10.0), (1, 1, 11.0), (1, 2, 20.0), (1, 2, 21.0), (1, 2, None), (2, 1, 1.0), (3, 2, 1.0), (1, 3, 9.0)]
    df = spark.createDataFrame(data, "number int, logger_number int, light double")
    got = P.pair_all(df, ["number"], ["light"]).collect()
    key = lambda p: (p[0], p[1], -1 if p[2] is None else p[2])
    assert sorted(((r.number, r.light_1, r.light_2) for r in got), key=key) == [
        (1, a, b) for a in (10.0, 11.0) for b in (None, 20.0, 21.0)
    ]


# --- line audit ----------------------------------------------------------------------------


def test_audit_counts_every_line_once(spark):
    lines = [
        ("a", "﻿Plot Title: 1,,,"),
        ("a", '#,"Date Time, GMT-06:00","Temp","Intensity"'),
        ("a", "1,09/25/22 9:00:00 AM,70.1,5.0,,"),
        ("a", "2,09/25/22 9:00:20 AM,70.1,5.0,Logged,"),
        ("a", "3,13/40/22 9:00:40 AM,70.1,5.0,,"),
        ("a", "4,,70.1,5.0,,"),
        ("a", ""),
        ("a", "  \r"),
        ("a", "battery low"),
        ("b", "x"),
        ("b", None),
    ]
    df = spark.createDataFrame(lines, "file_path string, value string")
    audit = {r.file_path: r.asDict() for r in LF.audit_lines(df).collect()}
    assert audit["a"] == {
        "file_path": "a", "lines": 9, "titles": 1, "headers": 1, "samples": 3, "events": 1, "blank": 2, "unread": 1, "bad_times": 1,
    }
    assert audit["b"]["lines"] == 2 and audit["b"]["unread"] + audit["b"]["blank"] == 2
    for counts in audit.values():
        assert counts["lines"] == sum(counts[k] for k in LF.AUDIT_KINDS)


def test_audit_totals_come_with_the_parse(spark):
    lines = [("x/1_a.csv", f"{n},09/25/22 9:00:{n:02d} AM,70.1,5.0,,") for n in range(1, 6)] + [("x/1_a.csv", "noise")]
    df = spark.createDataFrame(lines, "file_path string, value string")
    seen = Observation("totals")
    assert LF.parse_samples(df, "usual", audit=seen).count() == 5
    assert (seen.get["lines"], seen.get["samples"], seen.get["unread"]) == (6, 5, 1)


# --- dates by appearance -----------------------------------------------------------------


def test_dates_rank_by_first_row(spark):
    days = ["2022-11-09", "2022-09-25", "2022-11-09", None, "2022-10-03", "2022-09-25"]
    df = spark.createDataFrame(list(enumerate(days)), "at int, day string").select("at", F.to_date("day").alias("date"))
    by_place = {str(r.date): r.date_rank for r in W.unique_dates(df.repartition(3), order=["at"]).collect()}
    assert by_place == {"2022-11-09": 1, "2022-09-25": 2, "2022-10-03": 3}
    by_date = {str(r.date): r.date_rank for r in W.unique_dates(df).collect()}
    assert by_date == {"2022-09-25": 1, "2022-10-03": 2, "2022-11-09": 3}


def test_dates_rank_by_place_in_the_files(spark, tmp_path):
    days = [dt.date(2022, 1, 1) + dt.timedelta(days=(7 * i) % 50) for i in range(200)]
    path = str(tmp_path / "days")
    spark.createDataFrame([(d,) for d in days], "date date").coalesce(1).write.parquet(path)
    df = W.input_order(spark.read.parquet(path))
    got = {r.date: r.date_rank for r in W.unique_dates(df, order=["input_file", "input_row"]).collect()}
    assert got == {d: i for i, d in enumerate(dict.fromkeys(days), 1)}


# --- extents by recorded sensors -----------------------------------------------------------


def brute_extent(rows, sensors):
    """rows of one file: number, time, values by sensor."""
    used = [s for s in range(sensors) if any(v[s] is not None and not math.isnan(v[s]) for _, _, v in rows)]
    kept = [(n, t) for n, t, v in rows if n is not None and t is not None and all(v[s] is not None and not math.isnan(v[s]) for s in used)]
    kept.sort()
    if not kept:
        return "no row"
    short = kept[:-1]
    if not short:
        return (None, None, None)
    first, last = short[0][1], short[-1][1]
    return (first, last, (last - first).total_seconds() / (len(short) - 1) if len(short) > 1 else None)


def test_extent_of_files_that_lack_sensors(spark):
    rng = random.Random(21)
    files = {}
    for f in range(12):
        odds = [rng.choice([0.0, 0.6, 1.0]) for _ in range(2)]
        count = rng.choice([1, 2, 3, 65, 130, 300])
        numbers = rng.sample(range(400), count)
        files[f"f{f}"] = [
            (n, T0 + dt.timedelta(seconds=20 * n), [rng.choice([None, NAN]) if rng.random() >= o else 1.0 for o in odds]) for n in numbers
        ]
    data = [(f, n, t, *v) for f, rows in files.items() for n, t, v in rows]
    data += [("f0", None, T0, 1.0, 1.0), ("f1", 900, None, 1.0, 1.0), (None, 1, T0, 1.0, 1.0)]
    files["f0"].append((None, T0, [1.0, 1.0]))
    files["f1"].append((900, None, [1.0, 1.0]))
    df = spark.createDataFrame(data, "file_path string, number int, date_time timestamp_ntz, temp_f double, light double")
    got = X.recorded_extent(df.repartition(5), ["temp_f", "light"])
    result = {r.file_path: (r.first_date_time, r.last_date_time, r.measurement_interval) for r in got.collect()}
    expected = {f: brute_extent(rows, 2) for f, rows in files.items()}
    assert set(result) == {f for f, e in expected.items() if e != "no row"}
    for f, (first, last, interval) in result.items():
        assert (first, last) == expected[f][:2], f
        assert interval == (None if expected[f][2] is None else pytest.approx(expected[f][2])), f


def test_last_row_by_hash_aggregates(spark):
    df = spark.createDataFrame(
        [("a", T0, 5), ("a", T0, -3), ("a", T0 - dt.timedelta(seconds=1), 9), ("b", T0, 1)],
        "file_path string, date_time timestamp_ntz, id bigint",
    )
    kept = X.drop_last_row(df, ["file_path"], ["date_time", "id"])
    assert sorted(r.id for r in kept.collect()) == [-3, 9]
    assert "SortAggregate" not in plan_of(kept)
