"""Every registered query against its SQL in DuckDB, on the small tables."""

import pytest

import __spark_entry__ as contract
from check import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(contract.QUERIES) == set(contract.ORACLES)


@pytest.mark.parametrize("name", sorted(contract.QUERIES))
def test_matches_sql(spark, con, name):
    ok, ours, theirs, _, differing, columns = compare(spark, con, name, SF_DIR)
    assert columns[0] == columns[1]
    assert ours == theirs
    assert not differing[:3]
    assert ok


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["track", "zone", "mean_light_attenuation", "sd_light_attenuation"]
    assert df.count() > 0
