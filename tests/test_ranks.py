"""Places in an order, computed over ranges."""

import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plan_text import plan_of
from turbilux.operators.ranks import ranked


def _expected(rows, missing_last=True):
    def key(row):
        return tuple((v is None if missing_last else v is not None, 0 if v is None else v) for v in row[:-1])

    return [(*row, 1 + sum(key(o) < key(row) for o in rows)) for row in rows]


def _got(df, columns, **options):
    return [tuple(r) for r in ranked(df, columns, **options).select(*columns, "tag", "rank").collect()]


@pytest.mark.parametrize("missing_last", [True, False])
@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.lists(st.tuples(st.none() | st.integers(-3, 3), st.none() | st.sampled_from(["a", "b", "ü", ""])), max_size=30))
def test_ranks_equal_brute_force(spark, missing_last, data):
    rows = [(*r, i) for i, r in enumerate(data)]
    df = spark.createDataFrame(rows, "n long, s string, tag long").repartition(3)
    got = _got(df, ["n", "s"], missing_last=missing_last, ranges=4)
    assert sorted(got, key=lambda r: r[2]) == sorted(_expected(rows, missing_last), key=lambda r: r[2])


def test_one_key_with_most_rows_and_other_types(spark):
    at = datetime.datetime(2024, 3, 31, 2, 30)
    rows = [(at, 0.1, 1)] * 500 + [(at + datetime.timedelta(microseconds=i), i / 3, 2) for i in range(300)] + [(None, float("nan"), 3)]
    df = spark.createDataFrame(rows, "t timestamp_ntz, x double, tag long").repartition(5)
    found = _got(df, ["t", "x"], ranges=16)
    assert len(found) == len(rows)
    # the row at the same time with value 0 comes before the five hundred
    assert {r[3] for r in found if r[2] == 1} == {2}
    assert sorted(r[3] for r in found if r[2] == 2) == [1, *range(502, 801)]
    assert [r[3] for r in found if r[2] == 3] == [801]


def test_only_the_ranges_meet_in_one_task(spark):
    df = spark.range(10_000).withColumn("tag", F.col("id") % 7)
    plan = plan_of(ranked(df, ["tag", "id"], ranges=8))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert plan.count("SinglePartition") <= 2
