"""Sums that do not depend on the order of the rows."""

import math
import random
import statistics
import struct

import pytest
from pyspark.sql import functions as F

from turbilux.operators import cells as C
from turbilux.operators.exact_sums import order_free_stats, order_free_sums

NAN, INF = float("nan"), float("inf")


def bits(x):
    return None if x is None else struct.pack("<d", x)


@pytest.fixture(scope="module")
def values():
    rng = random.Random(5)
    wide = [(rng.choice("abc"), rng.uniform(-1, 1) * 10.0 ** rng.randint(-25, 25)) for _ in range(3000)]
    return wide + [("a", None), ("b", NAN), ("c", 0.0), (None, 2.5), (None, -7.25)]


def test_equal_bits_on_any_partitioning(spark, values):
    df = spark.createDataFrame(values, "k string, x double")

    def run(n):
        got = order_free_stats(
            df.repartition(n, F.rand(n)), ["k"], means={"mean": "x"}, sds={"sd": "x"}, sums={"total": "x"}, wholes={"n": F.lit(1)}
        )
        return {r.k: (bits(r["mean"]), bits(r.sd), bits(r.total), r.n) for r in got.collect()}

    first = run(1)
    assert first == run(3) == run(50)
    assert set(first) == {"a", "b", "c", None}


def test_sums_are_those_of_exact_arithmetic(spark, values):
    got = order_free_sums(spark.createDataFrame(values, "k string, x double"), ["k"], {"x": F.col("x")})
    for r in got.collect():
        known = [x for k, x in values if k == r.k and x is not None and not math.isnan(x)]
        assert r.x_n == len(known)
        assert r.x_sum == pytest.approx(math.fsum(known), rel=4e-16)


def test_nothing_is_lost_to_large_values(spark):
    data = [("a", x) for x in (1e17, 1.0, -1e17, 1e300, 3.0, -1e300, 5e-324)] + [("tiny", 5e-324)] * 3 + [("top", 1.7e308)]
    got = {r.k: r.x_sum for r in order_free_sums(spark.createDataFrame(data, "k string, x double"), ["k"], {"x": F.col("x")}).collect()}
    assert got == {"a": 4.0, "tiny": 1.5e-323, "top": 1.7e308}


def test_edges_of_bins(spark):
    edges = [s * math.nextafter(2.0**e, towards) for e in (-64, -32, 0, 32, 64) for towards in (0, INF) for s in (1, -1)]
    edges += [2.0**e for e in (-64, -32, 0, 32, 64)]
    for x in edges:
        row = order_free_sums(spark.createDataFrame([(1, x)], "k int, x double"), ["k"], {"x": F.col("x")}).first()
        assert row.x_sum == x


def test_missing_and_infinite(spark):
    data = [("none", None), ("nan", NAN), ("up", INF), ("up", 1.0), ("down", -INF), ("both", INF), ("both", -INF), ("one", 2.0)]
    got = order_free_stats(
        spark.createDataFrame(data, "k string, x double"), ["k"], means={"m": "x"}, sds={"s": "x"}, wholes={"n": F.lit(1)}
    )
    assert {r.k: (r.m, r.s, r.n) for r in got.collect()} == {
        "none": (None, None, 1),
        "nan": (None, None, 1),
        "up": (INF, None, 2),
        "down": (-INF, None, 1),
        "both": (None, None, 2),
        "one": (2.0, None, 1),
    }
    with pytest.raises(ValueError):
        order_free_stats(got, [], means={"m": "m"})


def test_empty_table(spark):
    empty = spark.createDataFrame([], "k string, x double")
    assert order_free_stats(empty, ["k"], means={"m": "x"}, sds={"s": "x"}).collect() == []


def test_deviation(spark):
    rng = random.Random(8)
    data = [(k, 1e6 + rng.gauss(0, 1)) for k in "ab" for _ in range(200)]
    got = order_free_stats(spark.createDataFrame(data, "k string, x double"), ["k"], sds={"s": "x"})
    for r in got.collect():
        assert r.s == pytest.approx(statistics.stdev([x for k, x in data if k == r.k]), rel=1e-12)


@pytest.mark.parametrize("roll", [lambda c, **o: c, C.day_mean, C.day_sum, C.experiment_mean])
def test_rollups_agree_with_plain_sums(spark, roll):
    rng = random.Random(3)
    poles = spark.createDataFrame(
        [(f"d{i % 4}", i % 3, str(i % 2), "AB"[i % 5 % 2], rng.uniform(-5, 90)) for i in range(400)],
        "date string, disturbance_number int, track string, zone string, light_attenuation_mean double",
    )
    plain = roll(C.cell_stats(poles))
    free = roll(C.cell_stats(poles, order_free=True), **({"order_free": True} if roll in (C.day_mean, C.day_sum, C.experiment_mean) else {}))
    assert sorted(plain.columns) == sorted(free.columns)
    keys = [c for c in plain.columns if c in C.CELL]
    one, other = (sorted((tuple(r[c] for c in keys), r) for r in df.collect()) for df in (plain, free))
    assert [k for k, _ in one] == [k for k, _ in other]
    for (_, a), (_, b) in zip(one, other):
        for c in set(plain.columns) - set(keys):
            assert b[c] == pytest.approx(a[c], rel=1e-12)
