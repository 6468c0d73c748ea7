import datetime as dt

import pytest
from pyspark.sql import functions as F

from plan_text import plan_of
from logger_writer import LAYOUTS, write_logger_file
from turbilux.operators.joins import samples_in_windows
from turbilux.sources import logger_files as LF
from turbilux.sources import metadata as MD
from turbilux.sources import names as N
from turbilux.sources import tables as TB

START = dt.datetime(2022, 9, 25, 11, 58)


def series(n=8, step=20):
    rows = [(i + 1, START + dt.timedelta(seconds=step * i), 80.5 + i, float(i), None) for i in range(n)]
    rows[3] = (4, rows[3][1], None, None, "End Of File")  # event inside the series
    rows[5] = (6, rows[5][1], 81.0, 0.0, "End Of File")  # event with a reading of no light
    return rows


@pytest.fixture
def logs(tmp_path):
    for i, layout in enumerate(LAYOUTS):
        write_logger_file(tmp_path / f"2098{i}_2022-09-25_export.csv", f"2098{i}", series(), layout, swap=layout == "minutes")
    return tmp_path


def expected(layout):
    cut = (lambda t: t.replace(second=0)) if layout == "minutes" else (lambda t: t)
    return [(n, cut(t), temp, light, event is not None) for n, t, temp, light, event in series()]


def test_three_layouts_in_one_scan(spark, logs):
    lines = spark.read.text(str(logs)).select(F.col("_metadata.file_path").alias("file_path"), "value")
    samples = LF.parse_samples(lines)
    assert samples.columns == list(LF.SAMPLE_COLUMNS)
    for i, layout in enumerate(LAYOUTS):
        mine = samples.filter(F.col("logger_sn") == f"2098{i}").orderBy("number").collect()
        assert [(r.number, r.date_time, r.temp_f, r.intensity_lum_ft2, r.is_event) for r in mine] == expected(layout)
        assert {r.gmt_offset for r in mine} == {"-05:00" if layout == "quoted" else "-06:00"}


def test_read_samples_takes_its_bound_from_the_listing(spark, logs):
    samples = LF.read_samples(spark, str(logs))
    assert samples.count() == 24
    assert samples.select("file_path").distinct().count() == 3
    assert "BroadcastHashJoin" in plan_of(samples)


def test_usual_layout_needs_one_pass(spark, logs):
    samples = LF.read_samples(spark, str(logs / "20980_2022-09-25_export.csv"), places="usual")
    got = samples.orderBy("number").collect()
    assert [(r.number, r.date_time, r.temp_f, r.intensity_lum_ft2, r.is_event) for r in got] == expected("quoted")
    assert {r.logger_sn for r in got} == {"20980"}
    assert plan_of(samples).count("FileScan text") == 1
    with pytest.raises(ValueError):
        LF.read_samples(spark, str(logs), places="guess")


def test_headers(spark, logs):
    lines = spark.read.text(str(logs)).select(F.col("_metadata.file_path").alias("file_path"), "value")
    heads = {r.logger_sn: r for r in LF.parse_headers(lines).collect()}
    assert heads["20980"].names[:4] == [
        "number", "date_time_gmt_05_00", "temp_f_lgr_s_n_20980_sen_s_n_20980", "intensity_lum_ft2_lgr_s_n_20980_sen_s_n_20980",
    ]
    assert [r.logger_sn for r in LF.unusual_headers(lines).collect()] == ["20981"]
    assert heads["20981"].temp_f_place == 4 and heads["20981"].intensity_lum_ft2_place == 3


def test_names(spark):
    assert N.clean_names_of(["#", "Date Time, GMT-05:00", "Temp, °F", "", "_c12", "a b", "A-B", "2nd"]) == [
        "number", "date_time_gmt_05_00", "temp_f", "x", "x_2", "a_b", "a_b_2", "x2nd",
    ]
    df = spark.createDataFrame([(1, 2, 3)], ["Point Name", "_c1", "_c2"])
    assert N.drop_spill_columns(N.clean_names(df)).columns == ["point_name"]


def test_metadata_sheet(spark, tmp_path):
    (tmp_path / "sheet.csv").write_text(
        "Date,Disturbance ID,point_name,coord_x,angle_degrees,,\n10/1/2022,1,a,-25,na,,\n2022-10-05, 2 ,b,?,165,,\n,x,NA,1.5,,,\n"
    )
    sheet = MD.read_metadata(spark, str(tmp_path / "sheet.csv"), MD.COORDINATE_TYPES)
    assert sheet.columns == ["date", "disturbance_id", "point_name", "coord_x", "angle_degrees", "x", "x_2"]
    assert [tuple(r) for r in N.drop_spill_columns(sheet).collect()] == [
        (dt.date(2022, 10, 1), 1, "a", -25.0, None),
        (dt.date(2022, 10, 5), 2, "b", None, 165.0),
        (None, None, None, 1.5, None),
    ]


def test_problem_sheet_keeps_its_words(spark, tmp_path):
    (tmp_path / "p.csv").write_text("Date,Pole ID,Disturbance,Problem\n2022-07-18,A,1,na\n")
    assert [tuple(r) for r in MD.read_problem_poles(spark, str(tmp_path / "p.csv")).collect()] == [
        (dt.date(2022, 7, 18), "A", 1, "na")
    ]


def test_disturbance_sheet(spark, tmp_path):
    (tmp_path / "d.csv").write_text("date,disturbance_number,start_time,end_time\n2022-09-25,1,9:37,10:00:30\n2022-10-01,3,na,?\n")
    day = dt.date(2022, 9, 25)
    assert [tuple(r) for r in MD.read_disturbances(spark, str(tmp_path / "d.csv")).collect()] == [
        (day, 1, dt.datetime(2022, 9, 25, 9, 37), dt.datetime(2022, 9, 25, 10, 0, 30)),
        (dt.date(2022, 10, 1), 3, None, None),
    ]


def test_tables_round_trip_and_prune(spark, logs, tmp_path):
    samples = LF.read_samples(spark, str(logs))
    later = samples.withColumn("date_time", F.expr("date_time + interval '3' day"))
    store = str(tmp_path / "store")
    TB.save_samples(samples.unionByName(later), store)
    stored = TB.load_table(spark, store)
    assert stored.count() == 48
    assert {str(d.name) for d in (tmp_path / "store").iterdir() if d.is_dir()} == {
        "sample_date=2022-09-25", "sample_date=2022-09-28",
    }
    windows = spark.createDataFrame(
        [(START, START + dt.timedelta(minutes=1))], "start_time timestamp_ntz, end_time timestamp_ntz"
    )
    inside = samples_in_windows(stored, windows, day=TB.SAMPLE_DAY)
    assert inside.count() == sum(
        1 for i in range(3) for n, t, *_ in expected(LAYOUTS[i]) if START <= t < START + dt.timedelta(minutes=1)
    )
    assert "dynamicpruning" in plan_of(inside).lower()


def test_stage_cuts_the_lineage(spark):
    df = spark.range(10).withColumn("y", F.col("id") * 2)
    staged = TB.stage(df)
    assert sorted(r.y for r in staged.collect()) == [2 * i for i in range(10)]
    assert "Scan ExistingRDD" in plan_of(staged)
    assert spark.sparkContext.getCheckpointDir()
